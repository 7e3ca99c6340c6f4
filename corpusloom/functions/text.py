"""Column functions that clean and take apart text. All take and give columns; null in, null out."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Headings that open the closing sections of an encyclopaedia page (Vietnamese), from the first of which text is cut.
CLOSING_SECTIONS = ("Liên kết ngoài", "Tham khảo", "Thể loại", "Xem thêm", "Đọc thêm")
#: Typographic punctuation and its ASCII counterpart, position by position.
PUNCTUATION = ('，。、„”“«»‘’´：？！（）；–—．～…━〈〉【】％►', ',.,"""""\'\'\':?!();--.~.-<>[]%-')


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"\s+"), F.lit(""))


def md5_numbers(words: pa.Array) -> np.ndarray:
    """The first 32 bits of each word's MD5 as a number; words that occur several times are hashed once."""
    d = words.dictionary_encode()
    if not len(d.dictionary):
        return np.zeros(0, np.int64)
    each = np.array([int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "big") for w in d.dictionary.to_pylist()], np.int64)
    return each[d.indices.to_numpy()]


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n{2,}")


def sentence_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[.!?]+(\s|$)"))


def md_links(text: Column) -> Column:
    return F.regexp_replace(text, r"\[([^\[\]]+)\]\(([^)]+)\)", "$1")


def wiki_clean(text: Column) -> Column:
    out = F.regexp_replace(text, r"\{\{[^}]+\}\}", "")
    out = F.regexp_replace(out, r"(?m)^\s+(?:\{\{|\|).+\n", "")
    out = F.regexp_replace(out, r"\([ ,;]*\)", "")
    return F.regexp_replace(out, f"(?ms)^(?:{'|'.join(CLOSING_SECTIONS)}).*", "")


def legal_clean(text: Column) -> Column:
    out = md_links(F.regexp_replace(text, r"\**(?:\\_)+\**", ""))
    return F.translate(F.replace(out, F.lit("/."), F.lit("")), " ", " ")


def paper_trim(text: Column) -> Column:
    """Title line, then from the abstract (else after the title) up to the references."""
    title = F.substring_index(text, "\n", 1)
    abstract = F.regexp_instr(text, F.lit("(?m)^Abstract"))
    references = F.regexp_instr(text, F.lit(r"(?m)^(?:\*\*)?References"))
    start = F.when(abstract > 0, abstract).otherwise(F.length(title) + 2)
    end = F.when(references > 0, references).otherwise(F.length(text) + 1)
    return F.concat(title, F.lit("\n"), F.substring(text, start, F.greatest(end - start, F.lit(0))))


def book_unwrap(text: Column) -> Column:
    """Join the wrapped lines of a book and drop its first line; a licence page becomes empty."""
    body = F.regexp_replace(F.regexp_replace(text, r"\[[^\]]+\]", ""), r"(?m)^[* ]+\n", "")
    rows = F.split(F.regexp_replace(body, "\n$", ""), "\n")

    def part(both: Column) -> Column:
        line, following = both["line"], both["following"]
        ends = line.rlike(r"[.!?:;,\\\"']$") | following.rlike(r"^\p{Lu}")
        apart = (line != "") & (following != "") & ends
        return F.when(apart, F.concat(line, F.lit("\n"))).otherwise(line)

    def joined(lines: Column) -> Column:
        # each line beside the next one (none after the last); looked up by position, the lines would be split again for each
        pairs = F.arrays_zip(F.slice(lines, F.lit(2), F.size(lines)).alias("line"), F.slice(lines, F.lit(3), F.size(lines)).alias("following"))
        return F.array_join(F.transform(pairs, part), "")

    return F.when(text.startswith("www.gutenberg.org/license."), F.lit("")).otherwise(F.transform(F.array(rows), joined)[0])


def unescape_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\\n"), F.lit("\n"))


def normalize_text(text: Column, strip: bool = True, punctuation: bool = True) -> Column:
    """Drop control characters and terminal colours; strip long blank runs at the document's ends; plain punctuation."""
    out = F.regexp_replace(text, "\x1b\\[[0-9;]*m", "")
    out = F.regexp_replace(out, "[\\x00-\\x08\\x0B\\x0E-\\x1F\\x7F]", "")
    if strip:
        out = F.regexp_replace(out, "^[ \r\t ]{4,}([^-*+ \r\t \\d])", "$1")
        out = F.regexp_replace(out, "[ \r\t ]{4,}$", "")
    return F.translate(out, *PUNCTUATION) if punctuation else out


def pii_redact(text: Column, email: str = "email@example.com", ip: str = "22.214.171.124") -> Column:
    """Replace e-mail addresses and public IPv4 addresses; private and loopback ranges stay."""
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    private = r"(?:10\.|127\.|192\.168\.|169\.254\.|0\.|172\.(?:1[6-9]|2\d|3[01])\.)"
    out = F.regexp_replace(text, r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", email)
    return F.regexp_replace(out, rf"\b(?!{private})(?:{octet}\.){{3}}{octet}\b", ip)


def placeholder_url(name: Column, key: Column | None = None) -> Column:
    base = F.concat(F.lit("https://"), F.translate(name, "_", "-"), F.lit(".example"))
    return base if key is None else F.concat(base, F.lit("/"), key.cast("string"))


def host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def registered_domain(url: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host(url), ".", -2)


def journal_key(url: Column) -> Column:
    """``domain`` or ``domain_identifier`` from the path of a journal's address."""
    parts = F.split(F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "^/", ""), "/")
    rest = F.when(F.get(parts, F.lit(0)) == "index.php", F.slice(parts, 2, 99)).otherwise(parts)
    one = F.get(rest, F.lit(0))
    plain = (F.size(rest) != 1) | one.isin("", "en", "vi", "vn", "index.php")
    return F.when(plain, host(url)).otherwise(F.concat_ws("_", host(url), one))


def endpoint(url: Column) -> Column:
    """The harvesting endpoint guessed from a journal's address."""
    return F.concat(F.regexp_replace(F.regexp_replace(url, "/index$", ""), "/$", ""), F.lit("/oai"))


def inferred_endpoint(address: Column, page: Column, domain: str, hub: str) -> Column:
    """The endpoint of a journal from its address (the page's refresh address, if it has one) and its page.

    A site that is all ``domain`` (its address ends in it) has no endpoint of its own: the first link to ``hub`` in the
    page is taken, null without one.
    """
    base = F.regexp_replace(F.regexp_replace(F.coalesce(F.nullif(meta_refresh(page), F.lit("")), address), "/index$", ""), "/$", "")
    link = F.nullif(F.regexp_extract(page, "(" + re.escape(hub) + r"[\w-]+)", 1), F.lit(""))
    return F.when(base.endswith(domain), link).otherwise(F.concat(base, F.lit("/oai")))


def friendly_name(model: Column) -> Column:
    """The family of a model from its ``owner/family-size`` name."""
    return F.split_part(F.split_part(model, F.lit("/"), F.lit(2)), F.lit("-"), F.lit(1))


def any_license(metadata: Column) -> Column:
    """Every licence is accepted, as the source's own test is switched off; the predicate is a seam for one."""
    return F.lit(True)


def sample(text: Column, n: int = 1000) -> Column:
    """The first ``n`` characters, for people to look at."""
    return F.substring(text, 1, n)


def endpoint_key(url: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(url, "/oai$", ""), "^https://", "")
    return F.replace(F.replace(out, F.lit("/index.php/"), F.lit("_")), F.lit("/"), F.lit("_"))


def meta_refresh(html: Column) -> Column:
    return F.regexp_extract(html, r"(?i)<meta\s+http-equiv=[\"']?refresh[\"']?\s+content=[\"'][^;\"']*;\s*url=([^\"']+)[\"']", 1)


def license_urls(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"[\"'](https?://creativecommons\.org/(?:licenses|publicdomain)/[^\"']+)[\"']"), F.lit(1))


def license_path(url: Column) -> Column:
    return F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), "/$", "")


def external_links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('<a href="([^"]+)/issue/archive" target="_blank">'), F.lit(1))


def license_ok(names: Column) -> Column:
    """Whether any licence is one of the four acceptable Creative Commons 4.0 ones (no ``-nd``)."""
    return F.coalesce(F.exists(names, lambda x: x.rlike(r"(?:by|by-sa|by-nc|by-nc-sa)/4\.0")), F.lit(False))


def capitalized(text: Column) -> Column:
    """First letter upper, the rest lower case, for the whole string."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, F.lit(2), F.length(text))))


def file_kind(content: Column) -> Column:
    return F.when(content.contains("/Text/"), "text").when(content.contains("/Image/"), "scanned").otherwise("unknown")


def hash_bucket(key: Column, seed: str, buckets: int = 1000) -> Column:
    """A number below ``buckets`` that any engine with MD5 works out alike."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key.cast("string"))), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def hash_unit(key: Column, seed: str) -> Column:
    """A number in (0, 1) from a key, the same in any engine with MD5."""
    return (F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key.cast("string"))), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def prompt_response(prompt: Column, response: Column, key: Column, seed: str = "prompt") -> Column:
    """One of four templates with weights .75, .15, .05 and .05, chosen by the key."""
    b = hash_bucket(key, seed, 100)
    return (
        F.when(b < 75, F.concat(prompt, F.lit("\n"), response))
        .when(b < 90, F.concat(F.lit("User: "), prompt, F.lit("\nAssistant: "), response))
        .when(b < 95, F.concat(F.lit("User: "), prompt, F.lit(" Assistant: "), response))
        .otherwise(F.concat(prompt, F.lit(" "), response))
    )


def chat_block(role: Column, message: Column) -> Column:
    """A message in chat markup; one without text leaves its block open."""
    head = F.concat(F.lit("<|im_start|>"), role, F.lit("\n"))
    return F.when(F.coalesce(message, F.lit("")) == "", head).otherwise(F.concat(head, message, F.lit("<|im_end|>\n")))
