"""The standard course pipeline: dump, metadata, archives, notebooks, PDFs, exercises, content and metadata files."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.paths import IPYNB, MIME_TYPES, PDF
from lectern.functions.rules import CourseRules
from lectern.models.client import ModelClient
from lectern.models.remote import BASE_URL, RemoteClient
from lectern.operators.archives import list_archive_files, read_archive_files
from lectern.operators.cache import Cache
from lectern.operators.exercises import split_exercises
from lectern.operators.metadata import infer_metadata
from lectern.operators.notebooks import notebooks_to_markdown
from lectern.operators.pdfs import Renderer, form_feed_pages, pdfs_to_markdown
from lectern.plans.pipeline import Pipeline, register
from lectern.runtime import materialise
from lectern.sinks.content_metadata import ContentMetadataSink
from lectern.sources.base import CourseDump
from lectern.sources.config import read_env
from lectern.sources.contents import with_content
from lectern.sources.files import read_images

#: What is transcribed and split.
EXERCISE_SHEETS = (("exam", "previous_year_exam"), ("practice", "homework"))


#: The setting that names the cache's folder.
CACHE_DIR = "CACHE_DIR"


#: What is taken out of archives besides documents: images that notebooks show.
IMAGES = sorted({kind for kind in MIME_TYPES.values() if kind.startswith("image/")})


def described_notebooks(df: DataFrame, dump: str, client: ModelClient | None, cache: Cache | None) -> DataFrame:
    """Archives expanded and their notebooks converted, with the images that lie in the dump or in the archives described.

    Archives are listed once, and their documents and images read in one pass, which is written to shared storage: no later stage opens an archive.
    """
    listed = materialise(list_archive_files(df, [PDF, IPYNB, *IMAGES], own_folder=True), "listed")
    files = materialise(with_content(read_archive_files(listed, keep=("__archive",))), "files")
    image = F.coalesce(F.col("__archive").isNotNull() & F.col("mime_type").isin(IMAGES), F.lit(False))
    images = read_images(df.sparkSession, dump).unionByName(files.where(image).select("path", "content"))
    return notebooks_to_markdown(files.where(~image).select(*df.columns), images, client, cache, keep_ending=True)


@register("course")
def course(dump: str, output: str, info: dict, lms_prefix: str, rules: CourseRules | None = None, client: ModelClient | None = None,
           render: Renderer = form_feed_pages, prefixes: tuple[str, ...] = ("./File",), cache: str | None = None, settings: str | None = None) -> Pipeline:
    """Metadata comes first: files from archives inherit their archive's, as the stages' order means.

    Every archive and every sheet has a folder of its own, and converted files keep their endings, so no two documents
    share a path. ``settings``: a ``.env`` file, whose ``CACHE_DIR`` names the cache where ``cache`` does not, and whose
    model settings make the client where none is given; without them the stand-in is used.
    """
    known = read_env(settings) if settings else {}
    kept = Cache(cache or known[CACHE_DIR]) if cache or known.get(CACHE_DIR) else None
    if client is None and known.get(BASE_URL):
        client = RemoteClient.from_settings(known)
    pairs = list(EXERCISE_SHEETS)
    return Pipeline(
        name="course",
        sources=(CourseDump(dump, lms_prefix, prefixes),),
        stages=(
            partial(infer_metadata, rules=rules or CourseRules()),
            partial(described_notebooks, dump=dump, client=client, cache=kept),
            partial(pdfs_to_markdown, pairs=pairs, client=client, render=render, cache=kept, keep_ending=True),
            partial(split_exercises, pairs=pairs, client=client, cache=kept, own_folder=True),
        ),
        sinks=(ContentMetadataSink(output, info, base=output),),
        info=info,
    )
