"""Column expressions over text: keys, cleaning, language and quality rules. All run inside the JVM."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(c: Column | str) -> Column:
    """The value, computed where it stands: filters and join keys made of it are not written out again below it, nor each use of it.

    The optimizer moves nothing through an expression that it holds not to be deterministic; the condition is always true.
    """
    return F.when(F.spark_partition_id() >= 0, col(c))


def let(c: Column | str, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once a row, however often f uses it."""
    return F.get(F.transform(F.array(col(c)), f), 0)


def present(c: Column | str) -> Column:
    """The value, or null where it is empty."""
    return F.nullif(col(c), F.lit(""))


#: All characters with the Unicode property White_Space.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column | str) -> Column:
    """Without white space at either end, Unicode blanks too."""
    return F.btrim(col(c), F.lit(WHITE))


@lru_cache(maxsize=1)
def _decomposed() -> tuple[str, str, dict[str, str]]:
    """By rule from the Unicode tables: characters that decompose to one ASCII letter, digit or blank; those letters; and the common longer decompositions."""
    single, to, longer = [], [], {}
    for c in map(chr, range(0x80, 0x1D800)):
        d = "".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii() and (x.isalnum() or x == " "))
        if len(d) == 1:
            single.append(c)
            to.append(d)
        elif len(d) > 1 and (c <= "ɏ" or "℀" <= c <= "↏" or "ﬀ" <= c <= "ﬆ"):
            longer[c] = d
    return "".join(single), "".join(to), longer


def spelt_out(c: Column, table: dict[str, str]) -> Column:
    """Single characters replaced by strings; texts without any of them are left alone."""
    pairs = F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in table.items()) + ")")  # one call for the whole table
    letters = F.transform(F.split(c, ""), lambda x: F.coalesce(F.element_at(pairs, x), x))
    return F.when(c.rlike("[" + "".join(table) + "]"), F.array_join(letters, "")).otherwise(c)


def ascii_fold(c: Column | str) -> Column:
    """Letters, digits and blanks under compatibility decomposition, for keys that drop all else afterwards.

    Longer decompositions are replaced for Latin letters, letter-like symbols, fractions, Roman numerals and ligatures.
    """
    single, to, longer = _decomposed()
    return F.translate(spelt_out(col(c), longer), single, to)


def normal_doi(c: Column | str) -> Column:
    """Lower case, without its prefixes; null where blank."""
    out = F.lower(strip(c))
    for p in V.DOI_PREFIXES:
        out = F.regexp_replace(out, "^" + p.replace(".", r"\."), "")
    return present(out)


def normal_title(c: Column | str) -> Column:
    """Letters, digits and single blanks; null for ten characters or fewer."""
    t = F.regexp_replace(F.lower(ascii_fold(c)), "[^a-z0-9 ]", "")
    t = F.trim(F.regexp_replace(t, " +", " "))
    return F.when(F.length(t) > 10, t)


def clean(c: Column | str) -> Column:
    """One kind of line end, at most one blank line, single blanks (X03); null counts as empty."""
    t = F.replace(F.replace(F.coalesce(col(c), F.lit("")), F.lit("\r"), F.lit("\n")), F.lit("\xa0"), F.lit(" "))
    # patterns run only over texts that hold what they look for
    lines = lambda t: F.when(t.contains("\n\n\n"), F.regexp_replace(t, "\n{3,}", "\n\n")).otherwise(t)
    blanks = lambda t: F.when(t.contains("  ") | t.contains("\t"), F.regexp_replace(t, "[ \t]{2,}", " ")).otherwise(t)
    white = lambda x: F.lit(WHITE).contains(x)
    ends = lambda t: F.when(white(F.substring(t, 1, 1)) | white(F.substring(t, -1, 1)), strip(t)).otherwise(t)
    return let(let(let(t, lines), blanks), ends)


def clean_or_missing(c: Column | str) -> Column:
    """Cleaned text, or N/A."""
    return F.coalesce(present(clean(c)), F.lit(V.MISSING))


def abstract_in(c: Column | str) -> Column:
    """What follows the word abstract, up to a blank line, keywords or introduction."""
    found = F.regexp_extract(F.coalesce(col(c), F.lit("")), V.ABSTRACT_PATTERN, 1)
    return clean(found)


def slug(c: Column | str) -> Column:
    """Runs of other characters as one underscore, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(col(c), "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))


def filename_doi(stem: Column | str) -> Column:
    """DOI of a file name's stem: without the year before it, the first double underscore as a slash."""
    rest = F.regexp_replace(col(stem), r"^(\d{4}|unknown)_", "")
    return F.regexp_replace(rest, "^(.*?)__", "$1/")


def filename_year(stem: Column | str) -> Column:
    """The year before a file name's stem, null if unknown."""
    return F.nullif(F.nullif(F.regexp_extract(col(stem), r"^(\d{4}|unknown)_", 1), F.lit("unknown")), F.lit(""))


def safe_file(c: Column | str, most: int) -> Column:
    """Without characters that file names may not have, cut."""
    return F.substring(F.regexp_replace(col(c), r'[<>:"/\\|?*]', "_"), 1, most)


def doi_filename(doi: Column | str, fmt: Column | str, year: Column | str) -> Column:
    """File name of a paper."""
    ext = F.when(col(fmt).isin("pdf", "xml", "html"), F.concat(F.lit("."), col(fmt))).otherwise(".bin")
    return F.concat(F.coalesce(present(F.trim(col(year).cast("string"))), F.lit("unknown")), F.lit("_"), safe_file(F.replace(col(doi), F.lit("/"), F.lit("__")), 200), ext)


def merged_text(abstract: Column | str, body: Column | str) -> Column:
    """Abstract and body, unless the body begins with the abstract."""
    a, b = clean(abstract), clean(body)
    has = F.substring(b, 1, 1200).contains(F.substring(a, 1, 120))
    return F.when(a == "", b).when(b == "", a).when(has, b).otherwise(F.concat(a, F.lit("\n\n"), b))


def language(c: Column | str) -> Column:
    """en, non-en or unknown by letters and function words of the first 6,000 characters."""

    def graded(t: Column, sample: Column, parts: Column, stops: Column) -> Column:
        # parts: what lies between runs of other characters than letters, empty before a leading and after a trailing one
        tokens = F.size(parts) - (F.get(parts, 0) == "").cast("int") - (F.get(parts, F.size(parts) - 1) == "").cast("int")
        tokens = F.when(F.size(parts) == 1, (F.get(parts, 0) != "").cast("int")).otherwise(tokens)
        share = F.length(F.array_join(parts, "")) / F.greatest(F.length(sample), F.lit(1))
        return F.when((F.length(t) < 80) | (tokens < 40), "unknown").when((share > 0.60) & (stops / F.greatest(tokens, F.lit(1)) > 0.04), "en").when(share < 0.35, "non-en").otherwise("unknown")

    def parted(t: Column, sample: Column, low: Column) -> Column:
        # a token is bounded by anything but letters, digits and underscores too; two other characters have a lower case with an ASCII letter
        of_low = let(F.split(low, "[^a-z]+"), lambda p: let(F.size(F.filter(p, lambda x: x.isin(V.STOP_WORDS))), lambda n: graded(t, sample, p, n)))
        rare = let(F.split(sample, "[^A-Za-z]+"), lambda p: graded(t, sample, p, F.size(F.filter(F.split(low, "[^a-z]+"), lambda x: x.isin(V.STOP_WORDS)))))
        return F.when(sample.contains("\u212a") | sample.contains("\u0130"), rare).otherwise(of_low)

    return let(strip(F.coalesce(col(c), F.lit(""))), lambda t: let(F.substring(t, 1, 6000), lambda s: let(F.lower(s), lambda low: parted(t, s, low))))


def count_markers(c: Column, markers: list[str]) -> Column:
    """How many of the markers occur."""
    return reduce(lambda a, b: a + b, [c.contains(m).cast("int") for m in markers])


def non_article(body: Column | str, title: Column | str, abstract: Column | str) -> Column:
    """Signs that a page is no article (F11); only short bodies are searched for them."""
    merged = F.lower(F.concat_ws("\n", col(title), col(abstract), col(body)))
    hits = let(merged, lambda m: count_markers(m, V.NON_ARTICLE_MARKERS))
    return ((F.length(col(body)) < 1800) & (hits >= 2)) | ((F.length(col(body)) < 300) & (F.length(col(abstract)) < 120))


#: Characters that end a line.
_BREAK = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"


def penalty(body: Column | str, abstract: Column | str, alone: bool = True) -> Column:
    """Points for boilerplate, wrong encoding, fragments and figure placeholders.

    Without `alone` fragments are looked for only where there is another sign: by themselves they are one point, which no rule asks for.
    """

    def lowered(low: Column) -> Column:
        boiler = F.when(count_markers(low, V.BOILERPLATE_MARKERS) >= 2, 2).otherwise(0)
        return boiler + F.when(low.contains(V.FIGURE_MARKER) & low.rlike(V.FIGURE_PATTERN), 1).otherwise(0)

    def fragments(lines: Column) -> Column:
        n = F.size(lines)
        return F.when((n > 0) & (F.size(F.filter(lines, lambda x: F.length(x) <= 3)) / F.greatest(n, F.lit(1)) > 0.08), 1).otherwise(0)

    def points(merged: Column) -> Column:
        strange = reduce(lambda a, b: a | b, [merged.contains(m) for m in V.MOJIBAKE_STARTS])
        noise = F.when(strange & (F.regexp_count(merged, F.lit(V.MOJIBAKE)) >= 5), 1).otherwise(0)
        lines = F.filter(F.transform(F.split(merged, f"[{_BREAK}]+"), strip), lambda x: x != "")
        others = let(F.lower(merged), lowered) + noise
        return others + let(lines, fragments) if alone else let(others, lambda n: F.when(n > 0, n + let(lines, fragments)).otherwise(0))

    return let(F.concat_ws("\n", col(abstract), col(body)), points)


def raw_label(title: Column | str, abstract: Column | str, body: Column | str) -> Column:
    """What kind of text was got, by lengths."""
    n, a = F.length(col(body)), F.length(col(abstract))
    return F.when(n >= V.COMPLETE_CHARS, "complete_full_text").when(n >= V.PARTIAL_CHARS, "partial_full_text").when(a >= V.ABSTRACT_CHARS, "abstract_only").when((col(title) != "") & (col(title) != V.MISSING), "title_only").otherwise("metadata_only")


def label_rank(c: Column | str) -> Column:
    """Rank of a label; unknown ones are 0."""
    pairs = [x for k, v in V.LABEL_RANK.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), col(c)), F.lit(0))


def clean_name(c: Column | str) -> Column:
    """A compound name in printable ASCII, Greek letters spelt out."""
    t = reduce(lambda e, x: F.replace(e, F.lit(x[0]), F.lit(x[1])), V.GREEK.items(), strip(F.coalesce(col(c), F.lit(""))))
    t = F.regexp_replace(ascii_fold(t), r"[^\x20-\x7E]", "")
    return F.trim(F.regexp_replace(t, " +", " "))


def name_key(c: Column | str) -> Column:
    """Lower-case clean name."""
    return F.lower(clean_name(c))


def compare_key(c: Column | str) -> Column:
    """Letters and digits of a name."""
    return F.regexp_replace(name_key(c), "[^a-z0-9]+", "")


def risky_name(c: Column | str) -> Column:
    """Too short to be looked up by similarity."""
    return F.length(compare_key(c)) <= 3


def curation_name(c: Column | str) -> Column:
    """A name as curation rules see it: folded case, quotes and dashes."""

    def folded(t: Column) -> Column:
        t = F.lower(ascii_fold(t))
        t = F.replace(F.replace(t, F.lit("α"), F.lit("alpha")), F.lit("β"), F.lit("beta"))
        return F.regexp_replace(F.regexp_replace(t, "[′’‘`´ʹ]", "'"), "[‐‑‒–—−]", "-")

    def spaced(t: Column) -> Column:
        t = F.replace(F.replace(t, F.lit("n,n0"), F.lit("n,n'")), F.lit("n0-"), F.lit("n'-"))
        return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))

    # ASCII texts, as long in bytes as in characters, have only one of the characters looked for
    plain = lambda t: F.replace(F.lower(t), F.lit("`"), F.lit("'"))
    return spaced(let(F.coalesce(col(c), F.lit("")), lambda t: F.when(F.octet_length(t) == F.length(t), plain(t)).otherwise(folded(t))))


def work_key(doi: Column | str, paper_id: Column | str) -> Column:
    """One key for the records of a work: its DOI, else its id without a trailing number."""
    d, p = curation_name(doi), curation_name(paper_id)
    return F.when((d != "") & (d != "not found"), F.concat(F.lit("doi:"), d)).otherwise(F.concat(F.lit("id:"), F.regexp_replace(p, r"_\d+$", "")))


def collapsed(c: Column | str) -> Column:
    """Lower case, single blanks."""
    return F.regexp_replace(strip(F.lower(F.coalesce(col(c), F.lit("")))), r"(?U)\s+", " ")


def or_not_found(c: Column | str) -> Column:
    """Trimmed, or NOT FOUND."""
    return F.coalesce(present(strip(col(c).cast("string"))), F.lit(V.NOT_FOUND))


def without_control(c: Column | str) -> Column:
    """For CSV: without control characters but tab and line ends."""
    return F.regexp_replace(col(c), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def found_or_empty(c: Column | str) -> Column:
    """NOT FOUND as empty."""
    t = F.trim(F.coalesce(col(c).cast("string"), F.lit("")))
    return F.when(F.upper(t) == V.NOT_FOUND, F.lit("")).otherwise(t)


def doi_of_url(c: Column | str) -> Column:
    """DOI of a resolver URL or a plain DOI."""
    t = strip(col(c))
    path = F.regexp_extract(t, r"(?i)^https?://(?:dx\.)?doi\.org/([^?#]+)", 1)
    return F.when(path != "", path).otherwise(F.regexp_replace(t, "(?i)^doi:", ""))


def content_format(head: Column | str) -> Column:
    """pdf, xml, html or json by the first characters."""
    h = F.lower(F.ltrim(F.substring(col(head), 1, 300)))
    return F.when(h.startswith("%pdf"), "pdf").when(h.contains("<html") | h.contains("<!doctype html"), "html").when(h.contains("<?xml") | h.contains("<article"), "xml").when(h.startswith("{") | h.startswith("["), "json")


def error_body(body: Column | str) -> Column:
    """A body too small or with signs of an error page."""
    low = F.lower(F.substring(col(body), 1, 5000))
    return (F.octet_length(col(body)) < 120) | (count_markers(low, V.ERROR_MARKERS) > 0)


def without_tags(c: Column | str) -> Column:
    """Without markup tags."""
    return strip(F.regexp_replace(col(c), "<[^>]+>", ""))


def year_of(c: Column | str) -> Column:
    """A year written in digits only."""
    t = col(c).cast("string")
    return F.when(t.rlike(r"^\d+$"), t.try_cast("int"))


def duration(seconds: Column | str) -> Column:
    """Seconds in the largest fitting unit."""
    s = col(seconds)
    return F.when(s < 60, F.concat(F.format_number(s, 1), F.lit("s"))).when(s < 3600, F.concat(F.format_number(s / 60, 1), F.lit("m"))).when(s < 86400, F.concat(F.format_number(s / 3600, 1), F.lit("h"))).otherwise(F.concat(F.format_number(s / 86400, 1), F.lit("d")))


def score_colour(score: Column | str) -> Column:
    """Plot colour of a score."""
    return F.when(col(score) <= 5, "red").when(col(score) >= 6, "green")
