"""Scalar text functions. All are built-in expressions but for Unicode normalisation, which Spark lacks:
a vectorised function handles the texts that have a character beyond ASCII, and sees null for the rest."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Arabic letters folded for matching; the last is dropped.
ARABIC_FROM, ARABIC_TO = "أإآىؤئةـ", "ااايويه"
_ARABIC = {ord(x): ARABIC_TO[i : i + 1] for i, x in enumerate(ARABIC_FROM)}
#: Words that stand for no value, case-folded.
NULL_LIKE = ["", "-", "--", "---", "n/a", "na", "none", "null", "nan", "not available", "not applicable"]
#: Words that carry no meaning in titles.
STOP_WORDS = ["the", "of", "for", "and", "to", "a", "an", "in", "on", "qatar", "قطر", "project", "tender", "مناقصه", "توريد", "تقديم"]


def text_of(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


@F.pandas_udf(StringType())
def _changes(s: pd.Series) -> pd.Series:
    """Of the characters of each text those that folding changes: the character and what it becomes, parted by U+0000."""
    known: dict[str, str] = {}

    def one(ch):
        if ch not in known:
            kept = (x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x) and unicodedata.category(x) != "Cf")
            known[ch] = "".join(kept).casefold().translate(_ARABIC)
        return known[ch]

    return s.map(lambda x: "\0".join(ch + one(ch) for ch in x if one(ch) != ch), na_action="ignore")


@F.pandas_udf(StringType())
def _nfkc_fold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x).casefold(), na_action="ignore")


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def _beyond_ascii(c: Column, function, plain) -> Column:
    odd = c.rlike(r"[^\x00-\x7F]")
    return F.coalesce(function(F.when(odd, c)), plain(c))


def bind(value: Column, f) -> Column:
    """f(value) with value computed once, where f names it many times and the expression would grow too large."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def squish(c: Column | str) -> Column:
    """White space runs become one space; trimmed; null becomes empty."""
    return _squished(text_of(c))


def _squished(c: Column) -> Column:
    # a lone space is left alone
    return F.trim(F.regexp_replace(c, r"(?U)\s\s+|[^\S ]", " "))


#: What separates words of a phrase, and what a reference to an outside document looks like.
SEPARATORS = r"[_\-/\\|(),:;.&+]+"
REFERENCE = r"(?U)(\b[A-Z0-9]+(?:[\-/][A-Z0-9]+){2,}\b)"


def fold_arabic(c: Column) -> Column:
    return F.translate(c, ARABIC_FROM, ARABIC_TO)


def _folded(c: Column) -> Column:
    """NFKD without marks and format characters, case folding and Arabic folding. Each is a matter of single characters, so Python sees
    only the distinct ones of texts that go beyond ASCII, and no batch of whole texts is held there."""
    odd = F.regexp_extract_all(F.when(c.rlike(r"[^\x00-\x7F]"), c), F.lit(r"[A-Z]|[^\x00-\x7F]"), F.lit(0))
    pairs = F.split(_changes(F.array_join(F.array_distinct(odd), "")), "\0")
    return F.coalesce(F.aggregate(pairs, c, lambda x, p: F.replace(x, F.substring(p, 1, 1), F.substr(p, F.lit(2)))), F.lower(c))


def norm_match(c: Column | str) -> Column:
    """For phrase matching: NFKD without marks and format characters, Arabic folding, case folding, a space
    between digit and Latin letter, punctuation to spaces."""
    x = F.regexp_replace(_folded(text_of(c)), r"(?U)(\d)(?=[A-Za-z])", "$1 ")
    return F.trim(F.regexp_replace(x, r"(?U)[\s" + SEPARATORS[1:], " "))


def norm_key(c: Column | str) -> Column:
    """For keys: NFKC, case folding, Arabic folding; marks and punctuation stay; null becomes empty."""
    return squish(fold_arabic(_beyond_ascii(text_of(c), _nfkc_fold, F.lower)))


def compact_key(c: Column | str) -> Column:
    return F.regexp_replace(norm_key(c), r"[^\p{L}\p{N}]", "")


def display_token(c: Column | str) -> Column:
    """Upper case; runs of other characters than letters and digits become one hyphen, none at the ends."""
    x = F.regexp_replace(F.upper(_beyond_ascii(text_of(c), _nfkc, lambda v: v)), r"[^\p{L}\p{N}]+", "-")
    return F.regexp_replace(x, "^-|-$", "")


def clean_text(c: Column | str) -> Column:
    """Squished; null where only a word for no value is left."""
    x = _squished((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.when(~F.lower(x).isin(NULL_LIKE), x)


def standard_scalar(c: Column | str) -> Column:
    """Trimmed text; blank becomes null. Nested values come in as JSON text."""
    # null stays null, so nothing is searched there
    x = F.regexp_replace((F.col(c) if isinstance(c, str) else c).cast("string"), r"(?U)^\s+|\s+$", "")
    return F.when(x != "", x)


def leaf_texts(variant: Column) -> Column:
    """The non-blank leaf texts of a nested value (variant), in document order with keys sorted, at any depth."""
    # strings that aren't keys, and scalars; a key is passed over by the last alternative
    leaf = r'(?s)("(?:[^"\\]|\\.)*+"(?!\s*:)|(?:^|(?<=[:\[,]))(?:-?[0-9][0-9.eE+-]*|true|false))|"(?:[^"\\]|\\.)*+"'
    rough = F.regexp_extract_all(F.to_json(variant), F.lit(leaf), F.lit(1))
    plain = F.transform(rough, lambda x: F.trim(F.when(x.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), x, F.lit("}")), "$.v")).otherwise(x)))
    return F.filter(plain, lambda x: x != "")


def context_text(parts: list[Column]) -> Column:
    """Leaf texts of several arrays, joined by ` | `."""
    return F.array_join(F.flatten(F.array(*[F.coalesce(p, F.array().cast("array<string>")) for p in parts])), " | ")


def first_text(*cols: Column | str) -> Column:
    """The first non-blank text, trimmed; empty where there is none."""
    return F.coalesce(*[standard_scalar(c) for c in cols], F.lit(""))


def title_tokens(c: Column | str) -> Column:
    """Distinct words of at least 3 characters, without stop words."""
    found = F.regexp_extract_all(norm_key(c), F.lit(r"(?U)([\w؀-ۿ]+)"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) >= 3) & ~w.isin(STOP_WORDS)))


def external_refs(c: Column | str) -> Column:
    """Distinct references: three or more alphanumeric segments joined by `-` or `/`, with a digit."""
    x = F.upper(_beyond_ascii(text_of(c), _nfkc, lambda v: v))
    found = F.regexp_extract_all(x, F.lit(REFERENCE), F.lit(1))
    return F.array_distinct(F.filter(found, lambda w: w.rlike("[0-9]")))


def pipe_field(c: Column | str, label: str) -> Column:
    """The value after `label |` up to the next `|`; null where there is none."""
    pattern = r"(?iu)\Q" + label + r"\E\s*\|\s*([^|]+)"
    return standard_scalar(F.regexp_extract(text_of(c), pattern, 1))


def sha24(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 24)


def build_url(prefix: str, token: Column, existing: Column) -> Column:
    """The scraped link, or else the prefix with the percent-encoded token."""
    made = F.concat(F.lit(prefix), F.replace(F.url_encode(standard_scalar(token)), F.lit("+"), F.lit("%20")))
    return F.coalesce(standard_scalar(existing), made)
