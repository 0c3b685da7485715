"""Column functions: metadata rules, paths and MIME types, HTML."""

from lectern.functions.html import anchors_of, clean_link_title, sections_of, starts_with_any
from lectern.functions.paths import guess_mime_type, is_junk, relative_to, stem, strip, with_suffix
from lectern.functions.rules import CourseRules, Keyword

__all__ = [
    "CourseRules", "Keyword", "anchors_of", "clean_link_title", "guess_mime_type", "is_junk", "relative_to", "sections_of",
    "starts_with_any", "stem", "strip", "with_suffix",
]
