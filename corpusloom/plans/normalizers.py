"""Sources of a corpus and the projection that brings the rows of each into one schema.

``normalize`` gives ``id bigint, text string, url string, metadata map<string,string>``. An id is the source's number
plus a thousand times a counter, so ``id % 1000`` tells the source. The url stands in the metadata; only ``mtet`` has it
beside them. Metadata also have ``origin`` and ``dataset_generated_id``, the row's id in its source, else the counter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


@dataclass(frozen=True)
class Source:
    """``text`` and ``url`` take the counter's column; without ``url`` rows get a placeholder address with their id."""

    number: int
    language: str
    schema: str
    text: Callable[[Column], Column] = lambda n: F.col("text")
    url: Callable[[Column], Column] | None = None
    #: metadata key and the expression it comes from
    keep: tuple[tuple[str, str], ...] = ()
    key: str | None = None
    extra: Callable[[], Column] | None = None
    url_on_top: bool = False


def _same(*names: str, of: str = "") -> tuple[tuple[str, str], ...]:
    return tuple((n, f"{of}`{n}`") for n in names)


def _is(expression: str) -> Callable[[Column], Column]:
    return lambda n: F.expr(expression)


def _prompt(question: str, answer: str) -> Callable[[Column], Column]:
    return lambda n: T.prompt_response(F.col(question), F.col(answer), n)


_WIKI = "id STRING, url STRING, title STRING, text STRING"
_META = (("title", "Tiêu đề"), ("scope", "Phạm vi"), ("industry", "Ngành"), ("sector", "Lĩnh vực"), ("effective_date", "Ngày có hiệu lực"), ("validity_status", "Tình trạng hiệu lực"))

SOURCES: dict[str, Source] = {
    "cosmopedia_v2": Source(1, "en", "text STRING, audience STRING, format STRING, seed_data STRING", keep=_same("audience", "format", "seed_data")),
    "fineweb_edu_dedup": Source(
        2, "en", "id STRING, text STRING, metadata STRUCT<dump STRING, url STRING, date STRING, file_path STRING, score DOUBLE, int_score BIGINT>",
        url=_is("metadata.url"), keep=_same("dump", "date", "file_path", "score", "int_score", of="metadata."), key="id",
    ),
    "starcoder_python_edu": Source(
        3, "code", "id STRING, content_cleaned STRING, max_stars_repo_name STRING, max_stars_repo_path STRING, language STRING, edu_score DOUBLE",
        text=_is("content_cleaned"), url=_is("concat('https://github.com/', max_stars_repo_name, '/', max_stars_repo_path)"), keep=_same("language", "edu_score"), key="id",
    ),
    "finemath_4plus": Source(4, "en", "text STRING, url STRING, warc_filename STRING, score DOUBLE", url=_is("url"), keep=_same("warc_filename", "score")),
    "olmocr_pes2o": Source(
        5, "en", "id STRING, text STRING, metadata STRUCT<`pdf-total-pages` BIGINT, fieldofstudy ARRAY<STRING>>", text=lambda n: T.paper_trim(F.col("text")),
        url=_is("concat('https://api.semanticscholar.org/graph/v1/paper/', id)"), keep=(("pdf-total-pages", "metadata.`pdf-total-pages`"), ("fieldofstudy", "array_join(metadata.fieldofstudy, '; ')")), key="id",
    ),
    "stackmathqa": Source(
        6, "en", "Q STRING, A STRING, meta STRUCT<url STRING, timestamp STRING, source STRING, answer_count BIGINT, answer_id STRING, question_score BIGINT>",
        text=_prompt("Q", "A"), url=_is("meta.url"), keep=_same("timestamp", "source", "answer_count", "answer_id", "question_score", of="meta."),
    ),
    "flan_v2": Source(7, "en", "inputs STRING, targets STRING, task STRING", text=_prompt("inputs", "targets"), keep=_same("task")),
    "wikipedia_en": Source(8, "en", _WIKI, text=lambda n: T.wiki_clean(F.col("text")), url=_is("url"), keep=_same("title"), key="id"),
    "claire_en": Source(
        9, "en", "id STRUCT<idx_row BIGINT>, text STRING, extra STRUCT<subset STRING>",
        url=lambda n: T.placeholder_url(F.lit("claire_en"), F.col("id.idx_row")), keep=_same("subset", of="extra."), key="id.idx_row",
    ),
    "gutenberg_en": Source(
        10, "en", "id STRING, title STRING, author STRING, text STRING", text=lambda n: T.book_unwrap(F.col("text")),
        url=lambda n: T.placeholder_url(F.lit("gutenberg_en"), F.col("id")), keep=_same("title"), key="id", extra=lambda: F.from_json("author", "map<string,string>"),
    ),
    "wikipedia_vi": Source(13, "vi", _WIKI, text=lambda n: T.wiki_clean(F.col("text")), url=_is("url"), keep=_same("title"), key="id"),
    "culturax": Source(14, "vi", "text STRING, url STRING, timestamp STRING, source STRING", url=_is("url"), keep=_same("timestamp", "source")),
    "madlad400": Source(15, "vi", "text STRING", text=lambda n: T.unescape_newlines(F.col("text"))),
    "fineweb2_hq": Source(
        16, "vi", "id STRING, text STRING, url STRING, date STRING, dump STRING, language_score DOUBLE, quality_score DOUBLE",
        url=_is("url"), keep=_same("date", "dump", "language_score", "quality_score"), key="id",
    ),
    "binhvq_news_corpus": Source(17, "vi", "text STRING"),
    "vbpl": Source(
        18, "vi", "id STRING, url STRING, markdown_content STRING, " + ", ".join(f"`{c}` STRING" for _, c in _META),
        text=lambda n: T.legal_clean(F.col("markdown_content")), url=_is("url"), keep=tuple((k, f"`{c}`") for k, c in _META), key="id",
    ),
    "mtet": Source(19, "vi", "prompt STRING, response STRING", text=_prompt("prompt", "response"), url_on_top=True),
}


def normalize(rows: DataFrame, name: str, counter: Column | None = None) -> DataFrame:
    """Rows of source ``name`` in the common schema.

    ``counter`` numbers the rows from 1; by default the numbers are Spark's own, unique but with gaps, which takes no
    shuffle. An author that isn't a JSON object adds nothing to the metadata.
    """
    source = SOURCES[name]
    n = (F.monotonically_increasing_id() + 1 if counter is None else counter).cast("bigint")
    rows = rows.withColumn("_n", n)
    n = F.col("_n")
    row_id = n * 1000 + source.number
    url = source.url(n) if source.url else T.placeholder_url(F.lit(name), row_id)
    pairs = [] if source.url_on_top else [("url", url)]
    pairs += [(k, F.expr(e)) for k, e in source.keep]
    pairs += [("origin", F.lit(name)), ("dataset_generated_id", F.expr(source.key) if source.key else n)]
    metadata = F.create_map(*[c for k, v in pairs for c in (F.lit(k), v.cast("string"))])
    if source.extra:
        metadata = F.map_concat(metadata, F.coalesce(source.extra(), F.expr("cast(map() as map<string,string>)")))
    return rows.select(row_id.alias("id"), source.text(n).alias("text"), (url if source.url_on_top else F.lit(None).cast("string")).alias("url"), metadata.alias("metadata"))


def language_of(name: str) -> str:
    """``en``, ``vi`` or ``code``; an unknown source raises KeyError."""
    return SOURCES[name].language
