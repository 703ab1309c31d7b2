"""Text normalisation and cleaning, all as built-in expressions but Unicode forms."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: HTML entities that are decoded; others are dropped.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}
#: Marks and what they become.
QUOTES = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-"}


def normalize_whitespace(text: Column, line_break: str = "unix") -> Column:
    """Tabs become spaces, line breaks one kind, runs of spaces one space, runs of blank lines one; trimmed."""
    c = F.regexp_replace(text, "\t", " ")
    c = F.regexp_replace(c, "\r\n?", "\n")
    c = F.regexp_replace(c, " +", " ")
    c = F.regexp_replace(c, "\n[ \n]*\n", "\n\n")
    c = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.regexp_replace(c, "\n", "\r\n") if line_break == "windows" else c


def collapse_whitespace(text: Column) -> Column:
    """Every run of white space is one space; trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def clean_text(text: Column, preserve_whitespace: bool = False) -> Column:
    """Without zero-width characters, and with white space collapsed unless it is to stay."""
    c = F.regexp_replace(text, "[​-‍﻿]", "")
    return F.trim(c) if preserve_whitespace else collapse_whitespace(c)


def indentation(text: Column, kind: str = "spaces") -> Column:
    return F.regexp_replace(text, "\t", "    ") if kind == "spaces" else F.regexp_replace(text, "    ", "\t")


def punctuation(text: Column, em_dash: str = "--") -> Column:
    """Typographic quotes, dashes and ellipses as ASCII."""
    c = F.translate(text, "".join(QUOTES), "".join(QUOTES.values()))
    c = F.regexp_replace(c, "—", em_dash)
    return F.regexp_replace(c, "…", "...")


def strip_html(text: Column) -> Column:
    """Without tags; six entities are decoded, others dropped."""
    c = F.regexp_replace(text, "<[^>]+>", "")
    for entity, char in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char)) if entity != "&amp;" else c
    c = F.regexp_replace(c, r"&(?!amp;)[a-zA-Z]+;|&#[0-9]+;", "")
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles and tags, white space collapsed."""
    c = F.regexp_replace(html, r"(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>", " ")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    return collapse_whitespace(F.regexp_replace(c, "<[^>]+>", " "))


def html_title(html: Column) -> Column:
    """The trimmed title, or null."""
    found = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.when(found != "", F.trim(found))


def html_links(html: Column) -> Column:
    """The href values of all anchors, in order."""
    return F.regexp_extract_all(html, F.lit(r"(?i)<a[^>]*\shref=[\"']([^\"']*)[\"']"), F.lit(1))


def html_meta(html: Column, name: str) -> Column:
    """The content of a meta tag by name or property, or null."""
    found = F.regexp_extract(html, rf"(?is)<meta[^>]+(?:name|property)=[\"']{name}[\"'][^>]*content=[\"']([^\"']*)[\"']", 1)
    return F.when(found != "", found)


def absolute_url(base: Column, link: Column) -> Column:
    """link as seen from base: absolute ones stay, rooted ones get the host, others base's folder."""
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(://[^/]+/(?:.*/)?)[^/]*$", "$1")
    return (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(folder, link))
    )


def special_characters(text: Column, allow_spaces: bool = True) -> Column:
    """Only ASCII letters, digits and, if allowed, spaces."""
    return F.regexp_replace(text, "[^a-zA-Z0-9 ]" if allow_spaces else "[^a-zA-Z0-9]", "")


def sanitize(text: Column, data_urls: bool = False) -> Column:
    """Without script and iframe blocks and javascript: links; with data_urls also without data: links."""
    c = F.regexp_replace(text, r"(?is)<script[^>]*>.*?</script>", "")
    c = F.regexp_replace(c, r"(?is)<iframe[^>]*>.*?</iframe>", "")
    c = F.regexp_replace(c, r"(?i)javascript:", "")
    return F.regexp_replace(c, r"(?i)data:[^\s\"']*", "") if data_urls else c


def trim_lines(text: Column) -> Column:
    """Lines trimmed, empty ones dropped."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def change_case(text: Column, case: str) -> Column:
    return {"lower": F.lower, "upper": F.upper, "title": F.initcap}.get(case, lambda c: c)(text)


def _form(form: str):
    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize(form, t))

    return convert


def unicode_form(text: Column, form: str = "NFC") -> Column:
    """NFC, NFD, NFKC or NFKD; Spark has no built-in, so an Arrow UDF. ASCII texts pass it by."""
    return F.when(text.rlike("^[\\x00-\\x7F]*$"), text).otherwise(_form(form)(text))


def strip_diacritics(text: Column) -> Column:
    return F.regexp_replace(unicode_form(text, "NFD"), r"\p{Mn}", "")


def normalize_text(text: Column, form: str = "NFC", case: str = "preserve", diacritics: bool = False, line_break: str = "unix") -> Column:
    """Unicode form, white space, punctuation, case, trimmed; with diacritics these are dropped first."""
    c = strip_diacritics(text) if diacritics else unicode_form(text, form)
    return F.trim(change_case(punctuation(normalize_whitespace(c, line_break)), case))


def safe_filename(name: Column, longest: int = 255) -> Column:
    return F.substring(F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]', "_"), 1, longest)


def pascal_case(name: Column) -> Column:
    """Words joined with capitals, the rest of each as it is in lower case."""
    return F.array_join(F.transform(F.split(F.trim(F.regexp_replace(name, "[^A-Za-z0-9]+", " ")), " "), F.initcap), "")


def singular(word: Column) -> Column:
    """ies becomes y, a closing s but not ss goes."""
    return F.when(word.endswith("ies"), F.regexp_replace(word, "ies$", "y")).when(word.rlike("[^s]s$"), F.regexp_replace(word, "s$", "")).otherwise(word)


def camel_case(name: Column) -> Column:
    p = pascal_case(name)
    return F.concat(F.lower(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))


def strip_honorific(name: Column) -> Column:
    """Without a leading title. The titles."""
    return F.trim(F.regexp_replace(name, r"(?i)^(Mr|Mrs|Ms|Dr|Prof|Sir|Madam)\.?\s+", ""))


def entity_kind(name: Column) -> Column:
    """Person for capitalised words with a space, Organization for one capitalised word, else Entity."""
    return F.when(name.rlike(r"^[A-Z].* "), "Person").when(name.rlike("^[A-Z]"), "Organization").otherwise("Entity")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def words(text: Column) -> Column:
    """Lower-cased words, split at white space; none for an empty text."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


#: Common words by which a language is told.
STOP_WORDS = {
    "en": ["the", "and", "of", "to", "is", "in", "that", "with"],
    "de": ["der", "die", "und", "das", "ist", "nicht", "ein", "mit"],
    "fr": ["le", "la", "et", "les", "des", "est", "une", "dans"],
    "es": ["el", "la", "que", "los", "y", "las", "una", "del"],
}


def language(text: Column, default: str = "en", shortest: int = 10) -> Column:
    """The language most of whose common words the text has; short texts and those with none get the default."""
    found = words(text)
    known = lambda common: F.size(F.filter(found, lambda w: w.isin(*common)))
    shares = [F.struct(known(s).alias("n"), F.lit(-i).alias("i"), F.lit(code).alias("code")) for i, (code, s) in enumerate(STOP_WORDS.items())]
    best = F.greatest(*shares)
    return F.when((F.length(text) < shortest) | (best["n"] == 0), default).otherwise(best["code"])
