"""Where resource tables go."""

from lectern.sinks.base import DummySink, Sink
from lectern.sinks.content_metadata import ContentMetadataSink, content_paths, documents_by_source
from lectern.sinks.course_files import read_manifest

__all__ = ["ContentMetadataSink", "DummySink", "Sink", "content_paths", "documents_by_source", "read_manifest"]
