"""A client of any endpoint that speaks the chat completions protocol, over the standard library's HTTP."""

from __future__ import annotations

import base64
import json
import time
import urllib.error
import urllib.request
from dataclasses import dataclass

from lectern.models.client import PNG

#: Names of the settings that ``from_settings`` reads.
BASE_URL, API_KEY, MODEL = "MODEL_BASE_URL", "MODEL_API_KEY", "MODEL_NAME"
#: Replies that another try may mend.
_AGAIN = {408, 409, 425, 429, 500, 502, 503, 504}

_TRANSCRIBE = "Transcribe this page of teaching material into Markdown. Keep headings, lists, tables and formulas (as LaTeX between $ signs), describe figures in one sentence, and reply with the Markdown only."
_STITCH = "These are the pages of one document, in order, each between triple backticks. Join them into one Markdown text: mend what page breaks cut, leave out running headers and page numbers, change nothing else. Reply with the Markdown only."
_SPLIT = "Cut this Markdown into its exercises. Give each exercise's or solution's text unchanged as snippet, its number as written, and whether it is a solution. Leave out what belongs to none."
_DESCRIBE = "Describe this image in one short sentence, as alternative text."
_EXERCISES = {
    "type": "object",
    "properties": {"exercises": {"type": "array", "items": {
        "type": "object",
        "properties": {"snippet": {"type": "string"}, "number": {"type": "string"}, "is_solution": {"type": "boolean"}},
        "required": ["snippet", "number", "is_solution"], "additionalProperties": False,
    }}},
    "required": ["exercises"], "additionalProperties": False,
}


class ModelError(RuntimeError):
    """The endpoint gave no usable reply."""


def image_url(image: bytes, mime_type: str = PNG) -> str:
    """An image as a data URL, the form in which a message carries it."""
    return f"data:{mime_type};base64,{base64.b64encode(image).decode()}"


@dataclass(frozen=True)
class RemoteClient:
    """The model ``name`` at ``base_url``. Calls are tried ``tries`` times, with growing pauses, where that may help."""

    name: str
    base_url: str
    key: str = ""
    timeout: float = 120.0
    tries: int = 4
    pause: float = 1.0
    #: Calls at once in a task.
    parallel: int = 8

    @classmethod
    def from_settings(cls, settings: dict[str, str], **options) -> RemoteClient:
        """From the settings ``MODEL_BASE_URL``, ``MODEL_NAME`` and, if there is one, ``MODEL_API_KEY``."""
        if missing := [k for k in (BASE_URL, MODEL) if not settings.get(k)]:
            raise ValueError(f"no setting {', '.join(missing)}")
        return cls(settings[MODEL], settings[BASE_URL], settings.get(API_KEY, ""), **options)

    def request(self, parts: list[dict] | str, schema: dict | None = None) -> str:
        """The reply to one message, stripped; with a ``schema`` it is JSON of that form."""
        body: dict = {"model": self.name, "messages": [{"role": "user", "content": parts}]}
        if schema is not None:
            body["response_format"] = {"type": "json_schema", "json_schema": {"name": "reply", "strict": True, "schema": schema}}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        call = urllib.request.Request(self.base_url.rstrip("/") + "/chat/completions", json.dumps(body).encode(), headers)
        for left in range(self.tries - 1, -1, -1):
            try:
                with urllib.request.urlopen(call, timeout=self.timeout) as reply:
                    text = json.load(reply)["choices"][0]["message"]["content"]
                if isinstance(text, str):
                    return text.strip()
                error: Exception = ModelError("a reply without text")
            except urllib.error.HTTPError as e:
                if e.code not in _AGAIN:
                    raise ModelError(f"{e.code}: {e.read()[:500]!r}") from e
                error = e
            except (urllib.error.URLError, TimeoutError, ValueError, LookupError) as e:
                error = e
            if left:
                time.sleep(self.pause * 2 ** (self.tries - 1 - left))
        raise ModelError(f"no reply from {self.base_url}: {error}") from error

    def _with_image(self, text: str, image: bytes, mime_type: str) -> str:
        return self.request([{"type": "text", "text": text}, {"type": "image_url", "image_url": {"url": image_url(image, mime_type)}}])

    def transcribe(self, page: bytes) -> str:
        return self._with_image(_TRANSCRIBE, page, PNG)

    def stitch(self, pages: list[str]) -> str:
        return self.request(_STITCH + "\n\n" + "\n\n".join(f"```\n{p}\n```" for p in pages))

    def split(self, text: str) -> list[dict]:
        reply = self.request(_SPLIT + "\n\n" + text, _EXERCISES)
        try:
            return [{k: e[k] for k in ("snippet", "number", "is_solution")} for e in json.loads(reply)["exercises"]]
        except (ValueError, LookupError, TypeError) as e:
            raise ModelError(f"not of the form asked for: {reply[:200]!r}") from e

    def describe(self, image: bytes, mime_type: str) -> str:
        return self._with_image(_DESCRIBE, image, mime_type)
