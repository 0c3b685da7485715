"""Where resource tables come from."""

from lectern.sources.base import CourseDump, Source, Table
from lectern.sources.config import read_env
from lectern.sources.contents import with_content
from lectern.sources.course_dump import last_links, read_dump, resolve, section_links
from lectern.sources.files import content_hash, data_url, read_binary, read_text

__all__ = [
    "CourseDump", "Source", "Table", "content_hash", "data_url", "last_links", "read_binary", "read_dump", "read_env", "read_text",
    "resolve", "section_links", "with_content",
]
