"""Path and MIME functions on columns."""

from __future__ import annotations

from mimetypes import MimeTypes

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKDOWN, PDF, ZIP = "text/markdown", "application/pdf", "application/zip"
IPYNB, MP4 = "application/x-ipynb+json", "video/mp4"

#: File endings and their types, where the standard library has none or, by version, another.
_OWN_TYPES = {
    ".7z": "application/x-7z-compressed", ".aac": "audio/aac", ".avi": "video/x-msvideo", ".avif": "image/avif", ".bat": "text/plain",
    ".bib": "text/x-bibtex", ".bmp": "image/bmp", ".c": "text/plain", ".cpp": "text/x-c++src", ".css": "text/css", ".csv": "text/csv",
    ".doc": "application/msword",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", ".gif": "image/gif",
    ".eps": "application/postscript", ".epub": "application/epub+zip", ".flac": "audio/flac", ".h": "text/plain", ".heic": "image/heic",
    ".htm": "text/html", ".html": "text/html", ".ico": "image/vnd.microsoft.icon", ".ipynb": IPYNB, ".java": "text/x-java", ".jpeg": "image/jpeg", ".jpg": "image/jpeg",
    ".js": "text/javascript", ".json": "application/json", ".m4a": "audio/mp4", ".md": MARKDOWN, ".mjs": "text/javascript",
    ".mov": "video/quicktime", ".mp3": "audio/mpeg", ".mp4": MP4, ".mpeg": "video/mpeg", ".mpg": "video/mpeg",
    ".odp": "application/vnd.oasis.opendocument.presentation", ".ods": "application/vnd.oasis.opendocument.spreadsheet",
    ".odt": "application/vnd.oasis.opendocument.text", ".ogg": "audio/ogg", ".opus": "audio/opus", ".pdf": PDF,
    ".png": "image/png", ".ppt": "application/vnd.ms-powerpoint",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation", ".ps": "application/postscript", ".py": "text/x-python",
    ".rtf": "application/rtf", ".sh": "application/x-sh", ".srt": "text/plain", ".svg": "image/svg+xml", ".tar": "application/x-tar",
    ".tex": "application/x-tex", ".tgz": "application/x-tar", ".tif": "image/tiff", ".tiff": "image/tiff", ".tsv": "text/tab-separated-values",
    ".txt": "text/plain", ".vtt": "text/vtt", ".wav": "audio/x-wav", ".weba": "audio/webm", ".webm": "video/webm", ".webp": "image/webp",
    ".xls": "application/vnd.ms-excel", ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".xml": "text/xml", ".zip": ZIP,
}
#: Short endings of compressed files, and the ending that their content has.
_SHORT = {short: MimeTypes(()).suffix_map[short].rsplit(".", 1)[0] for short in MimeTypes(()).suffix_map}
_KNOWN = MimeTypes(()).types_map[True] | _OWN_TYPES
#: All endings: the standard library's table, without this machine's own files, under the values above.
MIME_TYPES = {short: _KNOWN[ending] for short, ending in _SHORT.items() if ending in _KNOWN} | _KNOWN
#: Endings that only compress: the type is that of the name without them.
COMPRESSED = (".gz", ".bz2", ".xz", ".z", ".br")


def guess_mime_type(path: Column) -> Column:
    """The type by the path's ending, whatever its case; null for an unknown ending or none."""
    name = F.lower(F.regexp_replace(file_name(path), r"(?i)\.(gz|bz2|xz|z|br)$", ""))
    table = F.create_map(*[F.lit(x) for kv in MIME_TYPES.items() for x in kv])
    return F.try_element_at(table, F.regexp_extract(name, r"[^.]+(\.[^.]+)$", 1))


def mime_type_of(path: str) -> str | None:
    """``guess_mime_type`` of one path."""
    name = path.rsplit("/", 1)[-1].lower()
    for e in COMPRESSED:
        if name.endswith(e):
            name = name.removesuffix(e)
            break
    base, dot, ending = name.rpartition(".")
    return MIME_TYPES.get(dot + ending) if base and not base.endswith(".") else None


def inside(name: str) -> str:
    """An archive entry's name as a path that stays below its folder: no root, drive, empty part or ``..``."""
    name = name.replace("\\", "/")
    parts = (name[2:] if name[1:2] == ":" else name).split("/")
    return "/".join(p for p in parts if p not in ("", ".", ".."))


def of_junk(path: str) -> bool:
    """``is_junk`` of one path."""
    parts = path.split("/")
    return parts[-1] == ".DS_Store" or not {"__MACOSX", ".ipynb_checkpoints"}.isdisjoint(parts)


def file_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """What precedes the last slash; empty for a bare name."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def stem(path: Column) -> Column:
    """The file name without its last ending; a leading dot begins a name, not an ending."""
    return F.regexp_replace(file_name(path), r"(?s)(.)\.[^.]+$", "$1")


def with_suffix(path: Column, suffix: str) -> Column:
    """The path with its last ending replaced, or with one added where there is none."""
    folder = F.regexp_extract(path, r"(?s)^(.*/)?[^/]*$", 1)
    return F.concat(folder, stem(path), F.lit(suffix))


def relative_to(path: Column, base: str, to: str = "") -> Column:
    """The part of ``path`` below ``base``, after ``to``; a path elsewhere, or one with ``..``, is an error."""
    base = base.rstrip("/") + "/"
    inside = F.concat(F.lit(to), F.substring(path, len(base) + 1, 1 << 30))
    outside = F.raise_error(F.concat(F.coalesce(path, F.lit("null")), F.lit(f" is not below {base}")))
    below = F.startswith(path, F.lit(base)) & ~F.array_contains(F.split(path, "/"), "..")
    return F.when(below, inside).otherwise(outside.cast("string"))


def resolved(folder: Column, name: Column) -> Column:
    """Where a relative name leads from a folder, without ``.`` and ``..``; a name with a root or scheme of its own stands for itself."""
    root = r"^([A-Za-z][A-Za-z0-9+.\-]*:/*|/+)"
    whole = F.when(name.rlike(root), name).when(folder == "", name).otherwise(F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/"), name))
    lead = F.regexp_extract(whole, root, 1)
    parts = F.split(F.substring(whole, F.length(lead) + 1, F.length(whole)), "/")

    def step(done: Column, part: Column) -> Column:
        up = (F.size(done) > 0) & (F.element_at(done, -1) != "..")
        back = F.when(F.size(done) > 0, F.when(up, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(F.concat(done, F.array(part))))
        # nothing lies above a root
        return F.when(part.isin("", "."), done).when(part == "..", F.coalesce(back, F.when(lead != "", done).otherwise(F.array(part)))).otherwise(F.concat(done, F.array(part)))

    return F.concat(lead, F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))


def is_junk(path: Column) -> Column:
    """Files that archivers and editors leave behind."""
    parts = F.split(path, "/")
    folders = F.array(F.lit("__MACOSX"), F.lit(".ipynb_checkpoints"))
    return F.arrays_overlap(parts, folders) | (file_name(path) == ".DS_Store")


def strip(text: Column) -> Column:
    """Without white space at either end, by Unicode's notion of it."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
