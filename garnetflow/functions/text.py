"""Text functions on columns: the tokenisers by profile, cleaning, and parts of catalogue names.

Everything is a built-in expression. Word boundaries are spelled out in ASCII, since engines differ on what
they are beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed

_EDGE, _TAIL = "(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])"
VERSION = rf"{_EDGE}\d+\.\d+(\.\d+)*{_TAIL}"
#: How each profile finds its words: pattern of CVE ids to delete, pattern of words, least length.
PROFILES = {
    "train": (r"cve-\d{4}-\d+", "[a-z][a-z0-9]*", 3),
    "taxonomy": (rf"{_EDGE}cve-\d{{4}}-\d+{_TAIL}", "[a-z]{3,}", 3),
    "serving": (rf"{_EDGE}cve-\d{{4}}-\d+{_TAIL}", "[a-z]{3,}", 3),
    "report": (rf"{_EDGE}cve-\d{{4}}-\d+{_TAIL}", "[a-z]{3,}", 3),
    "ranking": (rf"{_EDGE}cve-\d{{4}}-\d+{_TAIL}", "[a-z]{3,}", 3),
    "batch": (None, "[a-z0-9]+", 3),
    "retrieval": (None, "[a-z0-9]+", 3),
    "cwe_name": (None, "[a-z0-9]+", 3),
}


def tokenize(text: Column | str, profile: str) -> Column:
    """The words of a text that count in a profile, in order and with repeats. Null gives null."""
    text = F.col(text) if isinstance(text, str) else text
    ids, word, least = PROFILES[profile]
    low = F.lower(text)
    if ids:
        # a plain look spares most texts the patterns with edges
        low = F.when(F.rlike(low, F.lit(r"\d\.\d")), F.regexp_replace(low, VERSION, "")).otherwise(low)
        low = F.when(F.contains(low, F.lit("cve-")), F.regexp_replace(low, ids, "")).otherwise(low)
    words = F.regexp_extract_all(low, F.lit(f"({word})"), 1)
    stop = fixed.STOP_WORDS[profile]
    return F.filter(words, lambda w: (F.length(w) >= least) & ~w.isin(*stop))


def trimmed(text: Column) -> Column:
    """Without white space at both ends, of every kind."""
    return F.regexp_replace(text, r"(^\s+)|(\s+$)", "")


def clean(text: Column) -> Column:
    """Tags go and leave nothing behind, then white space is collapsed."""
    return F.regexp_replace(trimmed(F.regexp_replace(text, "<[^>]+>", "")), r"\s+", " ")


def described(description: Column, extended: Column) -> Column:
    """Both descriptions, cleaned, with a space between those that are not empty."""
    return F.concat_ws(" ", F.nullif(clean(description), F.lit("")), F.nullif(clean(extended), F.lit("")))


def significant_words(text: Column) -> Column:
    """Words between white space without marks at their ends, longer than 3 bytes; their case is kept."""
    words = F.transform(F.split(trimmed(text), r"\s+"), lambda w: F.regexp_replace(w, r"""(^[.,;:!?()\[\]{}"']+)|([.,;:!?()\[\]{}"']+$)""", ""))
    return F.filter(words, lambda w: (F.octet_length(w) > 3) & ~w.isin(*fixed.STOP_WORDS["significant"]))


def weakness_context(name: Column) -> Column:
    """The phrase that a weakness's name turns on (what its parentheses hold, if any) and its longer words."""
    bare = F.regexp_replace(name, r"^CWE-\d+:\s*", "")
    inner = F.regexp_extract(bare, r"""\((['"]?)([^)'"]+)(['"]?)\)""", 2)
    phrase = F.lower(F.when(inner != "", inner).otherwise(bare))
    for prefix in fixed.CONTEXT_PREFIXES:
        phrase = F.regexp_replace(phrase, f"^{prefix}", "")
    words = F.transform(F.split(phrase, r"\s+"), lambda w: F.regexp_replace(w, "(^[',.]+)|([',.]+$)", ""))
    return F.concat(F.array(phrase), F.filter(words, lambda w: F.octet_length(w) >= 4))


def first_in_language(descriptions: Column, lang: str = "en") -> Column:
    """The value of the first of the descriptions in a language."""
    return F.get(F.filter(descriptions, lambda d: d["lang"] == lang)["value"], F.lit(0))


def first_of(rows: DataFrame, key: str, lang_column: str, lang: str, order: str, value: str) -> DataFrame:
    """key and value: the first of each key's rows in a language, without gathering its rows."""
    return rows.where(F.col(lang_column) == lang).groupBy(key).agg(F.min_by(value, order).alias("value"))


def weakness_ids(weaknesses: Column) -> Column:
    """Numbers of CWE ids, in order and with repeats; other values fall away."""
    values = F.flatten(F.transform(weaknesses, lambda w: w["description"]["value"]))
    return stripped_ids(values, "CWE-")


def id_set(ids: Column) -> Column:
    """Each id once, in the order of strings."""
    return F.array_sort(F.array_distinct(ids))


def stripped_ids(values: Column, prefix: str) -> Column:
    """Of the values that begin with the prefix, what follows it."""
    return F.transform(F.filter(values, lambda v: v.startswith(prefix)), lambda v: F.substring(v, len(prefix) + 1, 1 << 20))


def cve_name(value: Column) -> Column:
    """An id in upper case with its CVE- prefix."""
    up = F.upper(F.trim(value))
    return F.when(up.startswith("CVE-"), up).otherwise(F.concat(F.lit("CVE-"), up))


def weakness_list(value: Column) -> Column:
    """The numbers of a comma-separated list of CWE ids."""
    return F.transform(F.split(F.replace(value, F.lit(" ")), ","), lambda c: F.regexp_replace(F.upper(c), "^CWE-", ""))


def any_of(text: Column, words: list[str]) -> Column:
    """Whether the text holds any of the words: a chain of plain searches, which stays in generated code."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def all_of(text: Column, words: Column) -> Column:
    """Whether the text holds all words of an array column."""
    return F.forall(words, lambda w: F.contains(text, w))


def day_of(stamp: Column) -> Column:
    """The day of a time stamp with a zone; others stay as they are."""
    return F.when(stamp.rlike(r"(Z|[+-]\d{2}:\d{2})$"), F.substring(stamp, 1, 10)).otherwise(stamp)


def cut_bytes(text: Column, most: int = 30_000) -> Column:
    """The text, trimmed, down to whole characters within `most` bytes; null if nothing is left.

    No character is cut in two, so the result can be up to three bytes shorter than the limit.
    """
    data = F.encode(trimmed(text), "UTF-8")
    head = F.substring(data, 1, most)
    # a cut inside a character leaves a start byte without all its followers
    tail = F.regexp_extract(F.hex(F.substring(data, most - 2, 3)), "((?:C[0-9A-F]|D[0-9A-F])|E[0-9A-F](?:[89AB][0-9A-F])?|F[0-7](?:[89AB][0-9A-F]){0,2})$", 1)
    whole = F.when(F.octet_length(data) <= most, data).otherwise(F.substring(head, F.lit(1), F.lit(most) - (F.length(tail) / 2).cast("int")))
    return F.nullif(F.decode(whole, "UTF-8"), F.lit(""))


def titled(name: Column, description: Column) -> Column:
    """name: description, whichever there is."""
    return F.concat_ws(": ", F.nullif(name, F.lit("")), F.nullif(description, F.lit("")))


def escaped(text: Column) -> Column:
    """Text that is safe between and within HTML tags."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text
