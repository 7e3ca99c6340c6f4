"""The engine's queries by name, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup, filters, mixing, stats, vocabulary
from ..operators.ordering import with_row_number
from ..sources import files
from ..sources.shared import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')"
LINES = "string_split(text, chr(10))"
SHARE = lambda a, b: f"coalesce(round(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 6), 0.0)"
CHARS = lambda x: f"coalesce(list_sum(list_transform({x}, lambda y: length(y))), 0)"
BUCKET = lambda k, seed, n=1000: f"(('0x' || substr(md5('{seed}:' || CAST({k} AS VARCHAR)), 1, 8))::BIGINT % {n})"
UNIT = lambda k, seed: f"((('0x' || substr(md5('{seed}:' || CAST({k} AS VARCHAR)), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"
GRAMS = lambda n, w="w": f"list_transform(range(len({w}) - {n - 1}), lambda i: array_to_string({w}[i + 1 : i + {n}], ' '))"


# sources and sinks


@query("SELECT doc_id, text, lang, source, n_chars, 'documents' AS dump FROM documents")
def scan_docs(s, d):
    return files.read_documents(s, f"{d}/documents.parquet", dump="documents")


@query("SELECT doc_id, lang FROM documents WHERE n_chars > 1000")
def scan_prune(s, d):
    return read(s, d, "documents").where("n_chars > 1000").select("doc_id", "lang")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def jsonl_roundtrip(s, d):
    return files.jsonl_roundtrip(read(s, d, "documents"))


@query("SELECT CAST(floor(0.5 * coalesce(sum(length(text)), 0)) AS BIGINT) AS n_bytes FROM documents")
def estimate_size(s, d):
    return files.estimated_size(read(s, d, "documents"))


@query(
    "WITH s AS (SELECT greatest(1, CAST(floor(0.5 * sum(length(text))) AS BIGINT) // 500000) AS n FROM documents), r AS (SELECT doc_id, length(text) AS c, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT i % n AS shard, count(*) AS n_rows, CAST(sum(c) AS BIGINT) AS n_chars FROM r, s GROUP BY 1"
)
def shard_plan(s, d):
    return files.shard_plan(read(s, d, "documents"), shard_bytes=500_000)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def reshard(s, d):
    return files.reshard(read(s, d, "documents"), 8)


# projections


@query(
    "SELECT 1 + 1000 * row_number() OVER (ORDER BY doc_id) AS id, text, source AS origin, 'https://' || replace(source, '_', '-') || '.example/' || doc_id AS url, lang, CAST(doc_id AS VARCHAR) AS dataset_generated_id FROM documents"
)
def normalize_docs(s, d):
    rows = with_row_number(read(s, d, "documents"), "doc_id", "rn")
    return rows.select((1 + 1000 * F.col("rn")).alias("id"), "text", F.col("source").alias("origin"), T.placeholder_url(F.col("source"), F.col("doc_id")).alias("url"), "lang", F.col("doc_id").cast("string").alias("dataset_generated_id"))


@query("SELECT doc_id, 8 + 1000 * row_number() OVER (ORDER BY doc_id) AS row_id FROM documents")
def row_id(s, d):
    return with_row_number(read(s, d, "documents").select("doc_id"), "doc_id", "rn").select("doc_id", (8 + 1000 * F.col("rn")).alias("row_id"))


@query("SELECT doc_id, 'https://' || replace(source, '_', '-') || '.example/' || doc_id AS url FROM documents")
def placeholder_url(s, d):
    return read(s, d, "documents").select("doc_id", T.placeholder_url(F.col("source"), F.col("doc_id")).alias("url"))


@query("SELECT doc_id, text FROM documents WHERE source = 'src3'")
def origin_subset(s, d):
    return read(s, d, "documents").where("source = 'src3'").select("doc_id", "text")


@query("SELECT doc_id, text, source AS origin, CAST(NULL AS VARCHAR) AS url FROM documents")
def retain_metadata(s, d):
    return files.retain_metadata(
        read(s, d, "documents").select("doc_id", "text", F.create_map(F.lit("origin"), "source", F.lit("lang"), "lang").alias("metadata")), ("origin", "url")
    )


@query(
    f"WITH c AS (SELECT a.conv_id, a.turn, a.text AS p, b.text AS r, {BUCKET("a.conv_id || '-' || a.turn", 'prompt', 100)} AS b FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant')"
    " SELECT conv_id, turn, CASE WHEN b < 75 THEN p || chr(10) || r WHEN b < 90 THEN 'User: ' || p || chr(10) || 'Assistant: ' || r WHEN b < 95 THEN 'User: ' || p || ' Assistant: ' || r ELSE p || ' ' || r END AS text FROM c"
)
def prompt_template(s, d):
    c = read(s, d, "conversations")
    q = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("p"))
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("r"))
    return q.join(a, ["conv_id", "turn"]).select("conv_id", "turn", T.prompt_response(F.col("p"), F.col("r"), F.concat_ws("-", "conv_id", "turn")).alias("text"))


_WIKI = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace({t}, '\{{\{{[^}}]+\}}\}}', '', 'g'), '(?m)^\s+(?:\{{\{{|\|).+\n', '', 'g'), '\([ ,;]*\)', '', 'g'), '(?ms)^(?:Liên kết ngoài|Tham khảo|Thể loại|Xem thêm|Đọc thêm).*', '', 'g')"


#: What the tables lack is put around their texts, in Spark and in SQL alike, so that each rule has something to do.
_AROUND = {
    "wiki": ("{{Infobox|a=b}}head (, ;) x\n  | cell = 1\nbody {{cite}}\n", "\nTham khảo\ngone"),
    "links": ("see [here](http://a.b/c?d=(e)) and [not this]( ", " [end](x)"),
    "legal": ("**\\_\\_\\_** Điều 1/. [Luật](http://l) a\u00a0b ", " \\_"),
    "odd": ("\u00a0  \t x\x1b[31mred\x1b[0m \x07“quote”… ", "，end！   \t  "),
    "page": ('<meta http-equiv="refresh" content="0; url=https://r.example/x"><a href="https://j.example/a/issue/archive" target="_blank">"https://creativecommons.org/licenses/by/4.0/" ', "'http://creativecommons.org/publicdomain/zero/1.0/'"),
}


def _around(name: str, column: str):
    before, after = _AROUND[name]
    return F.concat(F.lit(before), F.col(column), F.lit(after))


def _around_sql(name: str, table: str, key: str, column: str) -> str:
    quoted = ["concat(" + ", ".join(f"chr({ord(c)})" if c < " " or c in "\\'\u00a0" else f"'{c}'" for c in x) + ")" for x in _AROUND[name]]
    return f"(SELECT {key}, {quoted[0]} || {column} || {quoted[1]} AS {column} FROM {table})"


@query("SELECT page_id, " + _WIKI.format(t="html") + f" AS text FROM {_around_sql('wiki', 'pages', 'page_id', 'html')}")
def wiki_clean(s, d):
    return read(s, d, "pages").select("page_id", T.wiki_clean(_around("wiki", "html")).alias("text"))


@query(r"SELECT doc_id, regexp_replace(text, '\[([^\[\]]+)\]\(([^)]+)\)', '\1', 'g') AS text FROM " + _around_sql("links", "documents", "doc_id", "text"))
def md_links(s, d):
    return read(s, d, "documents").select("doc_id", T.md_links(_around("links", "text")).alias("text"))


@query(r"SELECT doc_id, replace(replace(regexp_replace(regexp_replace(text, '\**(?:\\_)+\**', '', 'g'), '\[([^\[\]]+)\]\(([^)]+)\)', '\1', 'g'), '/.', ''), chr(160), ' ') AS text FROM " + _around_sql("legal", "documents", "doc_id", "text"))
def legal_clean(s, d):
    return read(s, d, "documents").select("doc_id", T.legal_clean(_around("legal", "text")).alias("text"))


_PUNCT_FROM, _PUNCT_TO = T.PUNCTUATION


@query(
    r"SELECT doc_id, translate(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\x1b\[[0-9;]*m', '', 'g'), '[\x00-\x08\x0B\x0E-\x1F\x7F]', '', 'g'), '^[ \r\t\x{A0}]{4,}([^-*+ \r\t\x{A0}\d])', '\1'), '[ \r\t\x{A0}]{4,}$', ''), "
    + f"'{_PUNCT_FROM}', '{_PUNCT_TO.replace(chr(39), chr(39) * 2)}') AS text FROM "
    + _around_sql("odd", "documents", "doc_id", "text")
)
def normalize_text(s, d):
    return read(s, d, "documents").select("doc_id", T.normalize_text(_around("odd", "text")).alias("text"))


@query(
    r"""WITH t AS (SELECT doc_id, text, string_split(text, chr(10))[1] AS title, regexp_extract(text, '(?m)^Abstract') AS a, regexp_extract(text, '(?m)^(?:\*\*)?References') AS r FROM documents),
p AS (SELECT doc_id, text, title, CASE WHEN a <> '' THEN (CASE WHEN starts_with(text, 'Abstract') THEN 1 ELSE instr(text, chr(10) || 'Abstract') + 1 END) ELSE length(title) + 2 END AS s,
 CASE WHEN r <> '' THEN length(text) - length(regexp_replace(text, '(?ms)^(?:\*\*)?References.*', '', 'g')) ELSE 0 END AS tail FROM t)
SELECT doc_id, title || chr(10) || substr(text, s, greatest(length(text) + 1 - tail - s, 0)) AS text FROM p"""
)
def paper_trim(s, d):
    return read(s, d, "documents").select("doc_id", T.paper_trim(F.col("text")).alias("text"))


@query(
    r"""WITH b AS (SELECT doc_id, starts_with(text, 'www.gutenberg.org/license.') AS lic, string_split(regexp_replace(regexp_replace(regexp_replace(text, '\[[^\]]+\]', '', 'g'), '(?m)^[* ]+\n', '', 'g'), '\n$', ''), chr(10)) AS l FROM documents)
SELECT doc_id, CASE WHEN lic THEN '' ELSE array_to_string(list_transform(range(2, len(l) + 1), lambda i: l[i] || CASE WHEN i < len(l) AND l[i] <> '' AND l[i + 1] <> '' AND (regexp_matches(l[i], '[.!?:;,\\"'']$') OR regexp_matches(l[i + 1], '^\p{Lu}')) THEN chr(10) ELSE '' END), '') END AS text FROM b"""
)
def gutenberg_unwrap(s, d):
    return read(s, d, "documents").select("doc_id", T.book_unwrap(F.col("text")).alias("text"))


_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"


@query(
    rf"""WITH e AS (SELECT doc_id, regexp_replace(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}\b', 'email@example.com', 'g') AS t FROM documents),
m AS (SELECT doc_id, regexp_replace(t, '\b((?:(?:10|127|0)\.{_OCTET}|192\.168|169\.254|172\.(?:1[6-9]|2\d|3[01]))\.{_OCTET}\.{_OCTET})\b', chr(57344) || '\1' || chr(57345), 'g') AS t FROM e)
SELECT doc_id, replace(replace(regexp_replace(t, '(^|[^{{}}\w])' || '(?:{_OCTET}\.){{3}}{_OCTET}\b', '\1' || '22.214.171.124', 'g'), chr(57344), ''), chr(57345), '') AS text FROM m""".replace("[^{}\\w]", "[^\\x{E000}\\w]")
)
def pii_redact(s, d):
    return read(s, d, "documents").select("doc_id", T.pii_redact(F.col("text")).alias("text"))


# filters


@query("SELECT p_partkey, p_retailprice, round_even(p_retailprice / 366, 0) AS score FROM part WHERE round_even(p_retailprice / 366, 0) >= 3")
def score_filter(s, d):
    score = F.bround(F.col("p_retailprice") / 366, 0)
    return read(s, d, "part").select("p_partkey", "p_retailprice", score.alias("score")).where("score >= 3")


_HOST = r"regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)"
_DOMAIN = f"array_to_string(list_slice(string_split({_HOST}, '.'), -2, -1), '.')"


@query(f"SELECT page_id, url, {_DOMAIN} AS domain, url IS NULL OR {_DOMAIN} = 'example.org' OR NOT ({_DOMAIN} IN ('example.net', 'example.org')) AS keep FROM pages")
def url_filter(s, d):
    domain = T.registered_domain(F.col("url"))
    return read(s, d, "pages").select("page_id", "url", domain.alias("domain"), filters.with_whitelist(domain.isin("example.net", "example.org"), F.col("url"), ("example.org",)).alias("keep"))


@query(
    rf"""WITH p AS (SELECT page_id, url, {_HOST} AS host, string_split(regexp_replace(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '^/', ''), '/') AS parts FROM pages),
q AS (SELECT *, CASE WHEN parts[1] = 'index.php' THEN parts[2:] ELSE parts END AS rest FROM p)
SELECT page_id, CASE WHEN len(rest) <> 1 OR rest[1] IN ('', 'en', 'vi', 'vn', 'index.php') THEN host ELSE host || '_' || rest[1] END AS journal,
regexp_replace(regexp_replace(url, '/index$', ''), '/$', '') || '/oai' AS endpoint,
replace(replace(regexp_replace(regexp_replace(url, '/oai$', ''), '^https://', ''), '/index.php/', '_'), '/', '_') AS endpoint_key FROM q"""
)
def url_key(s, d):
    u = F.col("url")
    return read(s, d, "pages").select("page_id", T.journal_key(u).alias("journal"), T.endpoint(u).alias("endpoint"), T.endpoint_key(u).alias("endpoint_key"))


LANGUAGES = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "mit", "für"),
    "en": ("the", "of", "and", "is", "with", "for", "that", "was"),
    "es": ("el", "los", "las", "que", "y", "por", "una", "se"),
    "fr": ("le", "les", "des", "et", "une", "est", "pour", "du"),
}
_LANG_SQL = (
    f"WITH w AS (SELECT doc_id, lang, {WORDS.replace('text', 'lower(text)')} AS w FROM documents), c AS (SELECT doc_id, lang, len(w) AS m, "
    + ", ".join(f"len(list_filter(w, lambda x: x IN ({', '.join(repr(x) for x in ws)}))) AS {k}" for k, ws in LANGUAGES.items())
    + " FROM w), b AS (SELECT *, greatest(de, en, es, fr) AS n FROM c), s AS (SELECT doc_id, lang, CASE WHEN n = 0 THEN 'und' WHEN de = n THEN 'de' WHEN en = n THEN 'en' WHEN es = n THEN 'es' ELSE 'fr' END AS detected, "
    + f"{SHARE('n', 'm')} AS score FROM b) "
)


@query(_LANG_SQL + "SELECT doc_id, lang, detected, score, detected = lang AND score >= 0.05 AS keep FROM s")
def lang_id(s, d):
    docs = read(s, d, "documents")
    return filters.language_scores(docs, LANGUAGES, ("lang",)).withColumn("keep", (F.col("detected") == F.col("lang")) & (F.col("score") >= 0.05))


@query(_LANG_SQL + "SELECT CASE WHEN score > 0.05 THEN detected ELSE 'other' END AS label, count(*) AS n FROM s GROUP BY 1")
def lang_share(s, d):
    return filters.language_scores(read(s, d, "documents"), LANGUAGES).groupBy(F.when(F.col("score") > 0.05, F.col("detected")).otherwise("other").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def _rep_sql() -> str:
    with_ = [
        f"r AS (SELECT doc_id, length(text) AS n, {WORDS} AS w, {LINES} AS l, string_split_regex(text, '\\n{{2,}}') AS p FROM documents)",
        "b AS (SELECT doc_id, n, " + CHARS("w") + " AS wc, " + ", ".join([
            f"{SHARE('len(l) - len(list_distinct(l))', 'len(l)')} AS dup_line_frac", f"{SHARE('len(p) - len(list_distinct(p))', 'len(p)')} AS dup_para_frac",
            f"{SHARE(CHARS('l') + ' - ' + CHARS('list_distinct(l)'), 'n')} AS dup_line_char_frac", f"{SHARE(CHARS('p') + ' - ' + CHARS('list_distinct(p)'), 'n')} AS dup_para_char_frac"]) + " FROM r)",
    ]
    cols, joins, bad = [], [], ["dup_line_frac > 0.3", "dup_para_frac > 0.3", "dup_line_char_frac > 0.2", "dup_para_char_frac > 0.2"]
    for n, limit in ((2, 0.2), (3, 0.18), (4, 0.16)):
        with_.append(f"g{n} AS (SELECT doc_id, g, count(*) AS c FROM (SELECT doc_id, unnest({GRAMS(n)}) AS g FROM r WHERE len(w) >= {n}) GROUP BY 1, 2)")
        with_.append(f"t{n} AS (SELECT doc_id, CASE WHEN c > 1 THEN c * length(g) ELSE 0 END AS top FROM g{n} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, length(g) DESC) = 1)")
        cols.append(f"{SHARE(f'coalesce(t{n}.top, 0)', 'n')} AS top_{n}")
        joins.append(f"LEFT JOIN t{n} USING (doc_id)")
        bad.append(f"top_{n} > {limit}")
    for n, limit in ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.1)):
        with_.append(f"p{n} AS (SELECT doc_id, i, g, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (SELECT doc_id, unnest(range(len(w) - {n - 1})) AS i, unnest({GRAMS(n)}) AS g FROM r WHERE len(w) >= {n}))")
        with_.append(f"c{n} AS (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i FROM p{n} WHERE c > 1)")
        with_.append(f"d{n} AS (SELECT doc_id, sum(length(w[i + 1])) AS dup FROM c{n} JOIN r USING (doc_id) GROUP BY 1)")
        cols.append(f"{SHARE(f'coalesce(d{n}.dup, 0)', 'wc')} AS dup_{n}")
        joins.append(f"LEFT JOIN d{n} USING (doc_id)")
        bad.append(f"dup_{n} > {limit}")
    return f"WITH {', '.join(with_)} SELECT *, NOT ({' OR '.join(bad)}) AS keep FROM (SELECT doc_id, dup_line_frac, dup_para_frac, dup_line_char_frac, dup_para_char_frac, {', '.join(cols)} FROM b {' '.join(joins)})"


@query(_rep_sql())
def gopher_rep(s, d):
    return filters.gopher_repetition(read(s, d, "documents"))


_GOPHER_SQL = (
    f"WITH r AS (SELECT doc_id, text, {WORDS} AS w, {LINES} AS l FROM documents), m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, {SHARE(CHARS('w'), 'len(w)')} AS avg_word_len, "
    + SHARE(r"len(list_filter(l, lambda x: regexp_matches(x, '^\s*[•*-]')))", "len(l)") + " AS bullet_frac, "
    + SHARE("len(list_filter(l, lambda x: suffix(x, '...') OR suffix(x, '…')))", "len(l)") + " AS ellipsis_frac, "
    + f"CAST(len(list_intersect(list_distinct(w), [{', '.join(repr(x) for x in filters.GOPHER_STOP_WORDS)}])) AS BIGINT) AS stop_words, "
    + SHARE(r"len(regexp_extract_all(text, '#|\.\.\.|…'))", "len(w)") + " AS symbol_ratio, "
    + SHARE(r"len(list_filter(w, lambda x: regexp_matches(x, '\p{L}')))", "len(w)") + " AS alpha_frac FROM r) "
    + "SELECT *, n_words BETWEEN 50 AND 100000 AND avg_word_len BETWEEN 3 AND 10 AND bullet_frac <= 0.9 AND ellipsis_frac <= 0.3 AND stop_words >= 2 AND symbol_ratio <= 0.1 AND alpha_frac >= 0.8 AS keep FROM m"
)


@query(_GOPHER_SQL)
def gopher_quality(s, d):
    return filters.gopher_quality(read(s, d, "documents"))


_POLICY = " OR ".join(f"contains(lower(x), '{p}')" for p in filters.POLICY_PHRASES)


@query(
    rf"WITH c AS (SELECT doc_id, array_to_string(list_filter(string_split(regexp_replace(text, '\[\d*\]|\[edit\]|\[citation needed\]', '', 'g'), chr(10)), lambda x: NOT ({_POLICY})), chr(10)) AS text_out FROM documents) SELECT doc_id, text_out, CAST(len(regexp_extract_all(text_out, '[.!?]+(\s|$)')) AS BIGINT) AS n_sentences, len(regexp_extract_all(text_out, '[.!?]+(\s|$)')) >= 3 AND NOT contains(lower(text_out), 'lorem ipsum') AS keep FROM c"
)
def c4_quality(s, d):
    return filters.c4_quality(read(s, d, "documents"))


_ENDS = " OR ".join(f"suffix(x, '{e}')" for e in filters.TERMINAL)


@query(
    f"WITH r AS (SELECT doc_id, text, list_filter({LINES}, lambda x: trim(x) <> '') AS l, len({WORDS}) AS n FROM documents), m AS (SELECT doc_id, "
    + f"{SHARE(f'len(list_filter(l, lambda x: {_ENDS}))', 'len(l)')} AS line_punct, {SHARE('len(list_filter(l, lambda x: length(x) <= 30))', 'len(l)')} AS short_lines, "
    + f"{SHARE(CHARS('l') + ' - ' + CHARS('list_distinct(l)'), CHARS('l'))} AS char_dup, {SHARE("length(text) - length(replace(text, chr(10), ''))", 'n')} AS newline_ratio FROM r) "
    + "SELECT *, line_punct > 0.1 AND short_lines < 0.67 AND char_dup < 0.1 AND newline_ratio <= 0.3 AS keep FROM m"
)
def fineweb_quality(s, d):
    return filters.fineweb_quality(read(s, d, "documents"))


FLAGGED = {"stupid": 4, "idiot": 5, "trash": None, "of the": 5, "to be": 2, "the and": 3}


def _flagged_sql(mode: str, scores: dict[str, int | None] = FLAGGED) -> str:
    weights = {w: 2.0 ** ((s or 3) - 5) * (len(w.split(" ")) - (mode == "as_written")) for w, s in scores.items()}
    pattern = "|".join(sorted(weights, key=lambda w: (-len(w), w)))
    case = " ".join(f"WHEN '{w}' THEN {v}::DOUBLE" for w, v in weights.items())
    return (
        rf"WITH r AS (SELECT doc_id, regexp_extract_all(lower(text), '(?:[^\p{{L}}\p{{N}}_]|^)({pattern})(?:[^\p{{L}}\p{{N}}_]|$)', 1) AS f, len({WORDS}) AS n FROM documents), "
        + f"m AS (SELECT doc_id, CAST(len(f) AS BIGINT) AS n_flagged, {SHARE(f'coalesce(list_sum(list_transform(f, lambda x: CASE x {case} END)), 0)', 'n')} AS ratio FROM r) SELECT *, ratio <= 0.01 OR {BUCKET('doc_id', 'flagged')} < 100 AS keep FROM m"
    )


@query(_flagged_sql("as_written"))
def flagged_words(s, d):
    return filters.flagged_words(read(s, d, "documents"), FLAGGED)


@query(_flagged_sql("syllables"))
def flagged_syllables(s, d):
    return filters.flagged_words(read(s, d, "documents"), FLAGGED, mode="syllables")


@query(
    f"WITH g AS ({_GOPHER_SQL}), r AS (SELECT documents.doc_id, source, g.keep AS gk, {LINES} AS l FROM documents JOIN g USING (doc_id)), f AS (SELECT CASE WHEN source = 'src7' THEN 'url' WHEN {SHARE('len(l) - len(list_distinct(l))', 'len(l)')} > 0.3 THEN 'gopher_rep' WHEN NOT gk THEN 'gopher_quality' ELSE 'kept' END AS reason FROM r) SELECT reason, count(*) AS n FROM f GROUP BY 1"
)
def filter_funnel(s, d):
    """The first failing filter of each document, counted."""
    from .curation import reasons

    return reasons(read(s, d, "documents"), blocked=("src7",)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


_VALUES = "SELECT doc_id, CAST(length(text) AS DOUBLE) / nullif(len(" + WORDS + "), 0) AS ppl FROM documents"


@query(
    f"WITH v AS ({_VALUES}), b AS (SELECT quantile_cont(round(ppl, 1), 0.2) AS lo, quantile_cont(round(ppl, 1), 0.8) AS hi FROM v) SELECT doc_id, round(ppl, 6) AS ppl, (ppl BETWEEN lo AND hi) OR {BUCKET('doc_id', 'quantile')} < 100 AS keep FROM v, b WHERE ppl IS NOT NULL"
)
def quantile_filter(s, d):
    v = read(s, d, "documents").select("doc_id", F.try_divide(F.length("text").cast("double"), F.size(T.words(F.col("text"))).cast("double")).alias("ppl")).where("ppl is not null")
    return filters.quantile_filter(v, "ppl").select("doc_id", F.round("ppl", 6).alias("ppl"), "keep")


# statistics

_M = (
    f"SELECT doc_id, lang, source, length(text) AS n_chars, len({WORDS}) AS n_words, len({LINES}) AS n_lines, len(string_split_regex(text, '\\n{{2,}}')) AS n_paragraphs, len(regexp_extract_all(text, '[.!?]+(\\s|$)')) AS n_sentences, "
    + f"{CHARS(WORDS)} AS word_chars, len(list_filter({LINES}, lambda x: length(x) <= 30)) AS short_lines, len(list_distinct({WORDS})) AS distinct_words FROM documents"
)


def _summary_sql(c: str, by: str = "") -> str:
    return f"SELECT {by + ', ' if by else ''}count({c}) AS n, CAST(sum({c}) AS BIGINT) AS total, round(avg({c}), 6) AS mean, min({c}) AS low, max({c}) AS high FROM ({_M})" + (f" GROUP BY {by}" if by else "")


@query(_summary_sql("n_chars"))
def doc_stats(s, d):
    return stats.summary(stats.doc_measures(read(s, d, "documents")), "n_chars")


@query(_summary_sql("n_lines", "lang"))
def line_stats(s, d):
    return stats.summary(stats.doc_measures(read(s, d, "documents")), "n_lines", ["lang"])


@query(_summary_sql("n_paragraphs"))
def paragraph_stats(s, d):
    return stats.summary(stats.doc_measures(read(s, d, "documents")), "n_paragraphs")


@query(_summary_sql("n_words", "lang"))
def word_stats(s, d):
    return stats.summary(stats.doc_measures(read(s, d, "documents")), "n_words", ["lang"])


@query(_summary_sql("n_sentences", "source"))
def sentence_stats(s, d):
    return stats.summary(stats.doc_measures(read(s, d, "documents")), "n_sentences", ["source"])


@query(f"SELECT {_HOST} AS key, count(*) AS n, CAST(sum(length(html)) AS BIGINT) AS total, round(avg(length(html)), 6) AS mean FROM pages GROUP BY 1 ORDER BY n DESC, key LIMIT 1000")
def stats_by_domain(s, d):
    return stats.top_groups(read(s, d, "pages").withColumn("n_chars", F.length("html").cast("bigint")), T.host(F.col("url")), "n_chars", 1000)


@query(f"WITH v AS ({_VALUES}) SELECT round(ppl, 1) AS value, count(*) AS total FROM v GROUP BY 1")
def stat_histogram(s, d):
    v = read(s, d, "documents").select(F.try_divide(F.length("text").cast("double"), F.size(T.words(F.col("text"))).cast("double")).alias("ppl"))
    return stats.histogram(v, "ppl")


@query("SELECT count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS total, min(length(text)) AS low, max(length(text)) AS high, round(avg(length(text)), 6) AS mean FROM documents")
def stats_merge(s, d):
    parts = stats.summary(read(s, d, "documents").select("source", F.length("text").cast("bigint").alias("c")), "c", ["source"])
    return stats.merged(parts).select("n", "total", "low", "high", "mean")


@query("SELECT source AS origin, count(*) AS n FROM documents GROUP BY 1")
def origin_counts(s, d):
    return read(s, d, "documents").groupBy(F.col("source").alias("origin")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT DISTINCT unnest({WORDS}) AS token FROM documents")
def distinct_tokens(s, d):
    return read(s, d, "documents").select(F.explode(T.words(F.col("text"))).alias("token")).distinct()


# deduplication

_AB = ", ".join(f"{{'a': {a}::BIGINT, 'b': {b}::BIGINT}}" for a, b in dedup.coefficients(128, 20250801))
_SIG = (
    f"h AS MATERIALIZED (SELECT doc_id, list_transform(list_distinct({WORDS}), lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT % {dedup.PRIME}) AS h FROM documents), "
    f"sig AS MATERIALIZED (SELECT doc_id, list_transform([{_AB}], lambda p: list_min(list_transform(h, lambda x: CAST((p.a::HUGEINT * x + p.b) % {dedup.PRIME} AS BIGINT)))) AS sig FROM h WHERE len(h) > 0)"
)
_HEADS = "heads AS MATERIALIZED (SELECT doc_id, sig, min(doc_id) OVER (PARTITION BY sig) AS head FROM sig), copies AS (SELECT head AS id_a, doc_id AS id_b FROM heads WHERE head < doc_id)"
_BANDS = "bands AS MATERIALIZED (SELECT doc_id, unnest(range(16)) AS band, unnest(list_transform(range(16), lambda b: md5(array_to_string(sig[8 * b + 1 : 8 * b + 8], ',')))) AS bucket FROM heads WHERE doc_id = head)"
_CAND = "cand AS MATERIALIZED (SELECT DISTINCT a.doc_id AS id_a, b.doc_id AS id_b FROM bands a JOIN bands b ON a.band = b.band AND a.bucket = b.bucket AND a.doc_id < b.doc_id)"
_NEAR = "near AS MATERIALIZED (SELECT * FROM (SELECT id_a, id_b, round(list_sum(list_transform(range(1, 129), lambda i: CASE WHEN a.sig[i] = b.sig[i] THEN 1 ELSE 0 END)) / 128.0::DOUBLE, 6) AS jaccard FROM cand JOIN sig a ON a.doc_id = id_a JOIN sig b ON b.doc_id = id_b) WHERE jaccard >= 0.85 UNION ALL SELECT id_a, id_b, 1.0::DOUBLE AS jaccard FROM copies)"


@query(f"WITH {_SIG} SELECT doc_id, md5(array_to_string(sig, ',')) AS sig_md5 FROM sig")
def minhash_signature(s, d):
    return dedup.minhash(read(s, d, "documents")).select("doc_id", F.md5(F.array_join(F.transform("sig", lambda v: v.cast("string")), ",")).alias("sig_md5"))


@query(f"WITH {_SIG}, {_HEADS}, {_BANDS}, {_CAND} SELECT * FROM cand UNION ALL SELECT * FROM copies")
def minhash_candidates(s, d):
    return dedup.candidates(stored(dedup.minhash(read(s, d, "documents")), "signatures"))


@query(f"WITH {_SIG}, {_HEADS}, {_BANDS}, {_CAND}, {_NEAR} SELECT * FROM near")
def near_dup_pairs(s, d):
    return dedup.near_pairs(read(s, d, "documents"))


@query(
    f"WITH RECURSIVE {_SIG}, {_BANDS.replace('FROM heads WHERE doc_id = head', 'FROM sig')}, {_CAND}, {_NEAR.replace(' UNION ALL SELECT id_a, id_b, 1.0::DOUBLE AS jaccard FROM copies', '')}, adj AS (SELECT id_b AS id, list(id_a) AS smaller FROM near GROUP BY 1), nodes AS (SELECT id, smaller, row_number() OVER (ORDER BY id) AS k FROM adj), "
    "walk AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS removed UNION ALL SELECT walk.k + 1, CASE WHEN len(list_filter(smaller, lambda x: NOT list_contains(removed, x))) > 0 THEN list_append(removed, id) ELSE removed END FROM walk JOIN nodes ON nodes.k = walk.k + 1) "
    "SELECT doc_id FROM documents WHERE NOT list_contains((SELECT removed FROM walk ORDER BY k DESC LIMIT 1), doc_id)"
)
def dedup_survivors(s, d):
    return dedup.survivors(read(s, d, "documents"))


@query("SELECT min(doc_id) AS doc_id, md5(text) AS digest, count(*) AS copies FROM documents GROUP BY text")
def exact_dedup(s, d):
    return dedup.exact_copies(read(s, d, "documents"))


@query(
    f"""WITH r AS (SELECT doc_id, {WORDS} AS w FROM documents), k AS (SELECT doc_id, unnest(range(len(w) - 49)) AS pos, unnest({GRAMS(50)}) AS g FROM r WHERE len(w) >= 50),
f AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) AS rn FROM k), l AS (SELECT doc_id, pos FROM f WHERE rn > 1),
c AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(pos, pos + 50)) AS i FROM l) GROUP BY 1),
t AS (SELECT doc_id, text, regexp_extract_all(text, '\\s*\\S+') AS p FROM documents)
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(p, lambda x, i: NOT list_contains(gone, i - 1)), '') END AS text, len(w) AS n_words, len(w) - coalesce(len(gone), 0) AS n_left, len(w) - coalesce(len(gone), 0) >= 50 AS keep
FROM r LEFT JOIN c USING (doc_id) JOIN t USING (doc_id)"""
)
def substring_dedup(s, d):
    return dedup.substring_dedup(read(s, d, "documents"))


_LOWER = WORDS.replace("text", "lower(text)")


@query(
    f"WITH b AS (SELECT DISTINCT unnest({GRAMS(13)}) AS g FROM (SELECT {_LOWER} AS w FROM benchmark) WHERE len(w) >= 13), x AS (SELECT DISTINCT doc_id, unnest({GRAMS(13)}) AS g FROM (SELECT doc_id, {_LOWER} AS w FROM documents) WHERE len(w) >= 13) SELECT doc_id, count(*) AS hits FROM x JOIN b USING (g) GROUP BY 1"
)
def decontaminate(s, d):
    return dedup.benchmark_overlap(read(s, d, "documents"), read(s, d, "benchmark"))


# tokens, splits, mixtures

_IDS = f"list_concat(list_concat([1], list_transform({WORDS}, lambda x: CAST(('0x' || substr(md5(x), 1, 8))::BIGINT % 49136 + 16 AS INTEGER))), [2])"


@query(f"SELECT doc_id, len(ids) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM (SELECT doc_id, {_IDS} AS ids FROM documents)")
def tokenize_docs(s, d):
    return mixing.tokenize(read(s, d, "documents")).select("doc_id", F.size("input_ids").alias("n_tokens"), F.md5(F.array_join(F.transform("input_ids", lambda v: v.cast("string")), ",")).alias("ids_md5"))


@query(
    f"WITH t AS (SELECT list(x ORDER BY doc_id, i) AS all_ids FROM (SELECT doc_id, unnest(ids) AS x, unnest(range(len(ids))) AS i FROM (SELECT doc_id, {_IDS} AS ids FROM documents))) SELECT CAST(b AS BIGINT) AS block_id, 2049 AS n_tokens, md5(array_to_string(all_ids[b * 2049 + 1 : (b + 1) * 2049], ',')) AS ids_md5 FROM (SELECT all_ids, unnest(range(len(all_ids) // 2049)) AS b FROM t)"
)
def pack_tokens(s, d):
    blocks = mixing.pack(mixing.tokenize(read(s, d, "documents")))
    return blocks.select("block_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join(F.transform("tokens", lambda v: v.cast("string")), ",")).alias("ids_md5"))


@query(f"SELECT doc_id, CASE WHEN {BUCKET('doc_id', 'split', 100)} < 80 THEN 'train' WHEN {BUCKET('doc_id', 'split', 100)} < 90 THEN 'val' ELSE 'test' END AS split FROM documents")
def train_val_test_split(s, d):
    return mixing.split(read(s, d, "documents").select("doc_id"))


@query("SELECT doc_id, lang FROM documents ORDER BY md5('20250801:' || doc_id), doc_id LIMIT 100")
def shuffle_take(s, d):
    return mixing.shuffle_take(read(s, d, "documents").select("doc_id", "lang"), 100)


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch FROM documents")
def corpus_batches(s, d):
    return mixing.batches(read(s, d, "documents"), 64)


@query("WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) SELECT doc_id, unnest(range(greatest(i - 63, 0), least(i, greatest(n // 64 - 1, 0)) + 1)) AS batch FROM r")
def corpus_windows(s, d):
    return mixing.batches(read(s, d, "documents"), 64, mode="as_written")


ANNEALING = {"src0": 0.1, "src1": 0.1, "src2": 0.2, "src3": 0.3, "src4": 0.2, "src5": 0.1}


def _mix_sql(weights: dict[str, float], n: int, seed: str, scaled: bool) -> str:
    w = " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in weights.items())
    names = ", ".join(f"'{k}'" for k in weights)
    return (
        f"WITH z AS (SELECT source, CASE source {w} END {'/ sum(length(text))' if scaled else '* 1.0::DOUBLE'} AS p FROM documents WHERE source IN ({names}) GROUP BY source), q AS (SELECT source, p / (SELECT sum(p) FROM z) AS p FROM z) "
        f"SELECT doc_id, source FROM documents JOIN q USING (source) ORDER BY round(-ln({UNIT('doc_id', seed)}) / p, 6), doc_id LIMIT {n}"
    )


@query(_mix_sql(ANNEALING, 100, "anneal", True))
def annealing_mix(s, d):
    return mixing.mixture(read(s, d, "documents"), "source", ANNEALING, 100, seed="anneal").select("doc_id", "source")


@query(_mix_sql({"src0": 0.55, "src1": 0.4, "src2": 0.05}, 60, "blocks", False))
def mix_blocks(s, d):
    return mixing.mixture(read(s, d, "documents"), "source", {"src0": 0.55, "src1": 0.4, "src2": 0.05}, 60, seed="blocks", size_scaled=False).select("doc_id", "source")


# conversations

_BLOCK = "CASE WHEN coalesce(text, '') = '' THEN '<|im_start|>' || role || chr(10) ELSE '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) END"


@query(f"SELECT conv_id, string_agg({_BLOCK}, '' ORDER BY turn, role, text) AS text FROM conversations GROUP BY 1")
def chatml(s, d):
    c = read(s, d, "conversations").select("conv_id", F.struct("turn", "role", "text").alias("m"))
    return c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("m")), lambda m: T.chat_block(m["role"], m["text"])), "").alias("text"))


SYSTEM = ("You answer requests with the help of the context that comes with them.", "You answer requests fully and to the point.")


@query(
    f"WITH u AS (SELECT a.conv_id, a.turn, a.text, b.text AS context FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn - 1 AND b.role = 'assistant' WHERE a.role = 'user') SELECT conv_id, turn, '<|im_start|>system' || chr(10) || CASE WHEN coalesce(context, '') <> '' THEN '{SYSTEM[0]}' ELSE '{SYSTEM[1]}' END || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || CASE WHEN coalesce(context, '') <> '' THEN '### Instruction:' || chr(10) || text || '### Context:' || chr(10) || context ELSE text END || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS text FROM u"
)
def chatml_instruct(s, d):
    from .chat import instruct

    return instruct(read(s, d, "conversations"), SYSTEM)


@query("SELECT conv_id, turn, '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS text FROM conversations WHERE role = 'user'")
def chatml_nosys(s, d):
    from .chat import without_system

    return without_system(read(s, d, "conversations"))


# licences, pages, harvest records


@query(r"""SELECT page_id, array_to_string(regexp_extract_all(html, '["''](https?://creativecommons\.org/(?:licenses|publicdomain)/[^"'']+)["'']', 1), ' ') AS licenses FROM """ + _around_sql("page", "pages", "page_id", "html"))
def license_extract(s, d):
    return read(s, d, "pages").select("page_id", F.array_join(T.license_urls(_around("page", "html")), " ").alias("licenses"))


_LIC = r"regexp_extract_all(text, '(?i)(?:CC BY(?:-[A-Z]+)* 4\.0|MIT License|Apache License|General Public License)')"


@query(
    rf"WITH l AS (SELECT doc_id, list_transform({_LIC}, lambda x: replace(replace(lower(x), 'cc ', ''), ' ', '/')) AS l FROM documents), o AS (SELECT doc_id, l, len(list_filter(l, lambda x: regexp_matches(x, '(?:by|by-sa|by-nc|by-nc-sa)/4\.0'))) > 0 AS ok FROM l) SELECT doc_id, array_to_string(l, ' ') AS licenses, ok AS acceptable, len(l) = 0 OR ok AS downloadable, NOT ok AS incompatible FROM o"
)
def license_ok(s, d):
    found = F.regexp_extract_all("text", F.lit(r"(?i)(?:CC BY(?:-[A-Z]+)* 4\.0|MIT License|Apache License|General Public License)"), F.lit(0))
    names = F.transform(found, lambda x: F.replace(F.replace(F.lower(x), F.lit("cc "), F.lit("")), F.lit(" "), F.lit("/")))
    ok = T.license_ok(F.col("l"))
    return read(s, d, "documents").select("doc_id", names.alias("l")).select("doc_id", F.array_join("l", " ").alias("licenses"), ok.alias("acceptable"), ((F.size("l") == 0) | ok).alias("downloadable"), (~ok).alias("incompatible"))


@query(
    r"""SELECT page_id, regexp_extract(html, '(?i)<meta\s+http-equiv=["'']?refresh["'']?\s+content=["''][^;"'']*;\s*url=([^"'']+)["'']', 1) AS refresh, CAST(len(regexp_extract_all(html, '<a href="([^"]+)/issue/archive" target="_blank">', 1)) AS INTEGER) AS n_external, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM """
    + _around_sql("page", "pages", "page_id", "html")
)
def html_extract(s, d):
    h = _around("page", "html")
    return read(s, d, "pages").select("page_id", T.meta_refresh(h).alias("refresh"), F.size(T.external_links(h)).alias("n_external"), F.regexp_extract(h, "(?is)<title>(.*?)</title>", 1).alias("title"))


_OAI = """WITH r AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN NULL ELSE list_value(replace(url, 'https://', 'https://view.'), url || '/downloadSuppFile/1') END AS relation, CASE WHEN page_id % 5 = 0 THEN ['text/html'] WHEN page_id % 11 = 0 THEN ['application/pdf', 'application/pdf'] ELSE ['application/pdf'] END AS format FROM pages),
f AS (SELECT page_id, format, list_filter(relation, lambda x: NOT contains(x, 'downloadSuppFile')) AS rel FROM r WHERE relation IS NOT NULL),
k AS (SELECT page_id, list_filter(rel, lambda x: contains(x, 'view')) AS v FROM f WHERE list_contains(format, 'application/pdf') AND NOT (len(format) <> len(rel) AND len(format) > 1))
SELECT page_id, v[-1] AS view_url, replace(v[-1], 'view', 'download') AS download_url FROM k WHERE len(v) > 0"""


@query(_OAI)
def oai_filter(s, d):
    from .harvest import usable_records

    i = F.col("page_id")
    rel = F.when(i % 7 == 0, F.lit(None)).otherwise(F.array(F.replace("url", F.lit("https://"), F.lit("https://view.")), F.concat("url", F.lit("/downloadSuppFile/1"))))
    pdf = F.lit("application/pdf")
    fmt = F.when(i % 5 == 0, F.array(F.lit("text/html"))).when(i % 11 == 0, F.array(pdf, pdf)).otherwise(F.array(pdf))
    return usable_records(read(s, d, "pages").select("page_id", rel.alias("relation"), fmt.alias("format"))).select("page_id", "view_url", "download_url")


@query("SELECT page_id, CASE WHEN contains(c, '/Text/') THEN 'text' WHEN contains(c, '/Image/') THEN 'scanned' ELSE 'unknown' END AS kind FROM (SELECT page_id, html || CASE WHEN page_id % 3 = 0 THEN '/Font /Text/ /Image/' WHEN page_id % 3 = 1 THEN '/XObject /Image/' ELSE '' END AS c FROM pages)")
def classify_kind(s, d):
    i = F.col("page_id") % 3
    content = F.concat("html", F.when(i == 0, "/Font /Text/ /Image/").when(i == 1, "/XObject /Image/").otherwise(""))
    return read(s, d, "pages").select("page_id", T.file_kind(content).alias("kind"))


# vocabulary and embeddings

_VOC = f"v AS (SELECT token, count(*) AS n FROM (SELECT unnest({WORDS}) AS token FROM documents) GROUP BY 1)"


@query(
    rf"WITH {_VOC}, k AS (SELECT DISTINCT lower(token) AS s FROM v WHERE n >= 20 AND regexp_full_match(token, '\p{{L}}+')), x AS (SELECT token, n, list_filter(string_split_regex(trim(lower(regexp_replace(token, '[^\p{{L}} ]', ' ', 'g'))), ' +'), lambda y: y <> '') AS s FROM v WHERE n >= 3), m AS (SELECT DISTINCT token FROM (SELECT token, unnest(s) AS s FROM x) WHERE s NOT IN (SELECT s FROM k)) SELECT token, n, token NOT IN (SELECT token FROM m) AS in_language FROM x"
)
def vocab_lang(s, d):
    v = stored(vocabulary.token_counts(read(s, d, "documents")).where("n >= 3"), "vocabulary")
    known = v.where("n >= 20").where(F.col("token").rlike(r"^\p{L}+$")).select(F.lower("token").alias("syllable"))
    return vocabulary.by_language(v, known, 3)


@query(
    rf"""WITH {_VOC}, b AS (SELECT DISTINCT w AS token FROM (SELECT unnest({WORDS}) AS w FROM benchmark)), r AS (SELECT token, n, CASE WHEN regexp_full_match(token, '\p{{L}}+') THEN token ELSE regexp_replace(token, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g') END AS c FROM v WHERE n >= 2),
k AS (SELECT c, max(n) AS n FROM r WHERE regexp_full_match(c, '\p{{L}}+') AND (c IN (SELECT token FROM r) OR upper(c[1]) || lower(c[2:]) IN (SELECT token FROM r) OR lower(c) IN (SELECT token FROM r)) GROUP BY 1),
f AS (SELECT c AS token, row_number() OVER (ORDER BY n DESC, c) AS rn, count(*) OVER () AS total FROM k WHERE c NOT IN (SELECT token FROM b) AND (NOT regexp_full_match(c, '[A-Za-z]+') OR lower(c) IN ('the', 'thinge'))) SELECT token, rn FROM f WHERE rn <= total // 128 * 128"""
)
def vocab_merge(s, d):
    v = vocabulary.token_counts(read(s, d, "documents")).where("n >= 2")
    return vocabulary.merge(v, vocabulary.token_counts(read(s, d, "benchmark")), ("the", "thinge"))


@query(f"WITH {_VOC} SELECT l AS \"left\", r AS \"right\", CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, token[i] AS l, token[i + 1] AS r FROM (SELECT token, n, unnest(range(1, length(token))) AS i FROM v)) GROUP BY 1, 2 HAVING sum(n) >= 2")
def bpe_pair_counts(s, d):
    return vocabulary.pair_counts(read(s, d, "documents"), 2)


@query("SELECT label, CAST(i AS INTEGER) AS pos, round(avg(CAST(x AS DOUBLE)), 6) AS mean FROM (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY 1, 2")
def embed_mean(s, d):
    return vocabulary.mean_vector(read(s, d, "embeddings"), "label")


@query(
    "WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings), m AS (SELECT label, i, round(avg(CAST(x AS DOUBLE)), 6) AS mean FROM e GROUP BY 1, 2) SELECT vec_id, CAST(i AS INTEGER) AS pos, round(0.9::DOUBLE * mean + (1 - 0.9::DOUBLE) * CAST(x AS DOUBLE), 5) + 0.0::DOUBLE AS x FROM e JOIN m USING (label, i)"
)
def embed_blend(s, d):
    return vocabulary.blend(read(s, d, "embeddings"), "label", "vec_id")


# events


@query("SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS moving_avg FROM events")
def moving_avg(s, d):
    return mixing.moving_average(read(s, d, "events"), "value", ["ts", "event_id"], ["user_id"]).select("event_id", "user_id", "moving_avg")


@query("SELECT event_id, k AS key, json_extract_string(props, '$.' || k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def events_json(s, d):
    return read(s, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))


from . import more_queries as _more  # noqa: E402, F401  (adds its queries)
