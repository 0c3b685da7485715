"""Stages and operators over resource tables."""

from lectern.operators.archives import entries, expand_archive_files, expand_archives
from lectern.operators.cache import Cache, cache_key, hits, misses
from lectern.operators.exercises import dedup_exercises, parse_reply, split_exercises, split_text, unique_exercises
from lectern.operators.gates import change_where, concatenate, counted, explode_where, in_pairs
from lectern.operators.metadata import infer_metadata
from lectern.operators.notebooks import describe_images, images_rewritten, markdown_of, notebooks_to_markdown
from lectern.operators.pdfs import fenced, pages, pdfs_to_markdown

__all__ = [
    "Cache", "cache_key", "change_where", "concatenate", "counted", "dedup_exercises", "describe_images", "entries",
    "expand_archive_files", "expand_archives",
    "explode_where", "fenced", "hits", "images_rewritten", "in_pairs", "infer_metadata", "markdown_of", "misses", "notebooks_to_markdown",
    "pages", "parse_reply", "pdfs_to_markdown", "split_exercises", "split_text", "unique_exercises",
]
