"""Records from captured pages and payloads, as column expressions over (page, url, text or html)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.functions.dates import english_months
from noticeworks.functions.text import squish, standard_scalar, text_of
from noticeworks.naming import others, unused

#: Kinds of negotiations; numbers such as XY-RFQ-1409; times such as 13-Sep-2026 9:10 AM; labels of a deadline, in
#: English and in Arabic with each spelling of its first letter.
KINDS = "RFQ|RFP|RFI|ITT|EOI|RFX"
NUMBER = rf"[A-Z][A-Z\d]*-(?:{KINDS})-[A-Z\d][A-Z\d,./-]*"
TIME = r"\d{1,2}-[A-Z]{3}-\d{4} \d{1,2}:\d{2} [AP]M"
DEADLINE = r"(?i)^(?:(?:bid|tender)?\s*(?:closing|deadline|dead\s*line|close)\s*(?:date|time)?|[اأإآ]خر\s*موعد\s*للعطاء)\s*:?\s*"
#: A row of a page whose white space is squished: number, title, kind, status and three times.
RECORD_PATTERN = "(?i)" + " ".join([f"({NUMBER})", "(.*?)", f"({KINDS})", "([A-Z][A-Z ]{0,30}?)", *[f"({TIME})"] * 3])
RECORD_FIELDS = ["number", "title", "type", "status", "posted", "opened", "closes"]
#: Marks of pages that block a reader.
BLOCK_MARKERS = ["captcha", "access denied", "forbidden", "request rejected", "verify you are human", "unusual traffic"]
DATE_PATTERN = r"\d{1,2}\s+[A-Za-z]{3,9}\s+\d{4}|\d{1,2}[/-]\d{1,2}[/-]\d{4}|\d{4}-\d{2}-\d{2}"


def _all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text_of(c), F.lit(pattern), F.lit(group))


def records_from_text(df: DataFrame, text_col: str, pattern: str = RECORD_PATTERN, fields: list[str] | None = None) -> DataFrame:
    """A row for each match of a pattern with a group for each field, with its place pos on the page. The text is scanned once."""
    fields = fields or RECORD_FIELDS
    (hit,) = unused(df, "hit")
    hits = df.select(*others(df, text_col, "pos", *fields), F.posexplode(_all(squish(text_col), pattern)).alias("pos", hit))
    return hits.withColumns({f: squish(F.regexp_extract(hit, pattern, i + 1)) for i, f in enumerate(fields)}).drop(hit)


def valid_number(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(f"^(?:{pattern})$"), F.lit(False))


def valid_record(df: DataFrame, number: str, title: str, pattern: str, longest: int = 500) -> DataFrame:
    return df.where(valid_number(F.col(number), pattern) & F.length(squish(title)).between(1, longest))


def first_per_page_key(df: DataFrame, page: str, key: str, pos: str = "pos") -> DataFrame:
    w = Window.partitionBy(page, key).orderBy(pos)
    (n,) = unused(df, "n")
    return df.withColumn(n, F.row_number().over(w)).where(F.col(n) == 1).drop(n)


def lines_of(c: Column | str) -> Column:
    """Non-empty squished lines."""
    return F.filter(F.transform(F.split(text_of(c), r"\r?\n"), squish), lambda x: x != "")


def label_value_pairs(lines: Column, labels: list[str]) -> Column:
    """A map from each label found to the line after it; empty if that is a label too or missing. The first place counts."""
    after = lambda label: F.get(lines, F.array_position(lines, label).cast("int"))  # noqa: E731  positions count from 1
    value = lambda label: F.when(F.coalesce(after(label), F.lit("")).isin(labels), "").otherwise(F.coalesce(after(label), F.lit("")))
    found = [F.when(F.array_contains(lines, x), F.struct(F.lit(x).alias("key"), value(x).alias("value"))) for x in labels]
    return F.map_from_entries(F.array_compact(F.array(*found)))


def inline_pairs(lines: Column, labels: list[str]) -> Column:
    """A map from each label to the value of its first `label: value` line."""
    found = []
    for x in labels:
        hit = F.get(F.filter(lines, _labelled(x)), F.lit(0))
        found.append(F.when(hit.isNotNull(), F.struct(F.lit(x).alias("key"), F.trim(F.regexp_replace(hit, r"^[^:]*:", "")).alias("value"))))
    return F.map_from_entries(F.array_compact(F.array(*found)))


def _labelled(label: str):
    return lambda s: (F.trim(F.substring_index(s, ":", 1)) == label) & s.contains(":")


def with_inline_fallback(pairs: Column, inline: Column, needed: list[str]) -> Column:
    """pairs, or where one of the needed labels is empty, pairs filled from inline."""
    empty = reduce(lambda a, b: a | b, [F.coalesce(F.element_at(pairs, x), F.lit("")) == "" for x in needed])
    filled = F.map_concat(F.map_filter(inline, lambda k, v: F.coalesce(F.element_at(pairs, k), F.lit("")) == ""), F.map_filter(pairs, lambda k, v: (v != "") | F.element_at(inline, k).isNull()))
    return F.when(empty, filled).otherwise(pairs)


def deadline_value(lines: Column, label: str = DEADLINE) -> Column:
    """What stands behind a deadline label, or on the next line."""
    flags = F.transform(lines, lambda s: s.rlike(label))
    at = F.array_position(flags, True)
    inline = F.trim(F.regexp_replace(F.get(lines, (at - 1).cast("int")), label, ""))
    return F.when(at > 0, F.coalesce(F.nullif(inline, F.lit("")), F.get(lines, at.cast("int"))))


def drop_ghost_records(df: DataFrame, number: str, opened: str, labels: list[str]) -> DataFrame:
    """Drops records without an opening date, or whose number is a label."""
    return df.where(standard_scalar(opened).isNotNull() & ~F.coalesce(squish(number).isin(labels), F.lit(False)))


def to_dmy(c: Column) -> Column:
    """`Y-M-D` or `D-M-Y` (with `-` or `/`) as `DD-MM-YYYY`; else null."""
    p = F.split(F.translate(F.trim(c), "/", "-"), "-")
    two = lambda x: F.lpad(x, 2, "0")
    year_first = F.length(F.get(p, F.lit(0))) == 4
    made = F.when(year_first, F.concat_ws("-", two(F.get(p, F.lit(2))), two(F.get(p, F.lit(1))), F.get(p, F.lit(0)))).otherwise(F.concat_ws("-", two(F.get(p, F.lit(0))), two(F.get(p, F.lit(1))), F.get(p, F.lit(2))))
    return F.when(F.size(p) == 3, made)


_NUMERIC_DATE = r"\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}[-/]\d{1,2}[-/]\d{4}"


def labelled_dates(c: Column, sales_label: str, close_label: str) -> Column:
    """struct(sales_end, close): behind their labels, else the last two dates in the text; a single date is the close."""
    behind = lambda label: F.nullif(F.regexp_extract(text_of(c), rf"(?iu)(?:{label})[^0-9]*({_NUMERIC_DATE})", 1), F.lit(""))
    dates = _all(c, rf"({_NUMERIC_DATE})", 1)
    last = lambda k: F.when(F.size(dates) >= k, F.get(dates, F.size(dates) - k))
    labelled = behind(sales_label).isNotNull() | behind(close_label).isNotNull()
    sales = F.when(labelled, behind(sales_label)).otherwise(last(2))
    close = F.when(labelled, behind(close_label)).otherwise(last(1))
    return F.struct(to_dmy(sales).alias("sales_end"), to_dmy(close).alias("close"))


def cell_label_values(cells: DataFrame, labels: list[str], longest: int = 80) -> DataFrame:
    """Table cells (page, row, col, text) to (page, label, value): in the label's own cell after a colon, else in the
    next cell, else below it. Longer cells are no values; a label's first place with a value counts."""
    value = F.when((F.length(F.trim("text")) <= longest) & (F.trim("text") != "") & ~F.trim("text").isin(labels), F.trim("text"))
    named = reduce(lambda a, x: F.when(F.col("text").startswith(x), F.lit(x)).otherwise(a), sorted(labels, key=len), F.lit(None).cast("string"))
    own = cells.withColumns({"label": named, "value": value})
    hit = own.where("label is not null")
    right = own.select("page", "row", (F.col("col") - 1).alias("col"), F.col("value").alias("right"))
    below = own.select("page", (F.col("row") - 1).alias("row"), "col", F.col("value").alias("below"))
    near = hit.join(right, ["page", "row", "col"], "left").join(below, ["page", "row", "col"], "left")
    same = F.trim(F.regexp_replace(F.expr("substr(text, length(label) + 1)"), r"^\s*:\s*", ""))
    same = F.when((same != "") & (F.length(same) <= longest), same)
    found = near.withColumn("value", F.coalesce(same, "right", "below")).where("value is not null")
    return found.groupBy("page", "label").agg(F.min_by("value", F.struct("row", "col")).alias("value"))


def nth_date(c: Column | str, n: int, pattern: str = DATE_PATTERN) -> Column:
    """The nth date (from 0) of a text; null beyond the last."""
    return F.get(_all(text_of(c), f"({pattern})", 1), F.lit(n))


def split_row_at_type(parts: Column, link_text: Column, types: tuple[str, ...] = ("Internal", "External")) -> Column:
    """struct(type, authority, subject): authority is the first part after the type that is no date; subject is the
    link's text, or else the last part before the type that is no date."""
    at = F.array_position(F.transform(parts, lambda p: p.isin(list(types))), True)
    undated = lambda a: F.filter(a, lambda p: ~p.rlike(DATE_PATTERN) & (F.trim(p) != ""))
    after = undated(F.when(at > 0, F.slice(parts, (at + 1).cast("int"), F.size(parts))))
    before = undated(F.when(at > 1, F.slice(parts, F.lit(1), (at - 1).cast("int"))))
    return F.struct(
        F.when(at > 0, F.get(parts, (at - 1).cast("int"))).alias("type"),
        F.get(after, F.lit(0)).alias("authority"),
        F.coalesce(F.nullif(squish(link_text), F.lit("")), F.when(F.size(before) > 0, F.element_at(before, -1))).alias("subject"),
    )


def id_from_url(url: Column, parameter: str = "id") -> Column:
    """The trailing parentheses of a url's id parameter, decoded."""
    raw = F.regexp_extract(text_of(url), rf"[?&]{parameter}=([^&#]*)", 1)
    return F.nullif(F.regexp_extract(F.try_url_decode(raw), r"\(([^()]*)\)\s*$", 1), F.lit(""))


def strip_number_prefix(subject: Column, number: Column) -> Column:
    rest = F.regexp_replace(F.substr(subject, F.length(number) + 1), r"^[\s:/\-]+", "")
    return F.when((number != "") & F.startswith(subject, number), rest).otherwise(subject)


def title_before_date(text: Column, date_pattern: str = DATE_PATTERN, suffix: str = "Qatar") -> Column:
    first = F.regexp_extract(squish(text), rf"(?s)^(.*?)(?:{date_pattern}|$)", 1)
    return F.trim(F.regexp_replace(F.trim(first), rf"\s*{suffix}$", ""))


def require_identity(df: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """Drops records with neither id nor url; ids lose the prefix `tender_`."""
    plain = F.regexp_replace(squish(id_col), "^tender_", "")
    return df.withColumn(id_col, plain).where((F.col(id_col) != "") | (squish(url_col) != ""))


def card_fields(html: Column, label_class: str, value_class: str) -> Column:
    """A map from label to value: spans of two classes, zipped by place."""
    inner = lambda cls: F.transform(_all(html, rf'(?is)<(\w+)[^>]*class="[^"]*\b{cls}\b[^"]*"[^>]*>(.*?)</\1>', 2), plain_text)
    labels, values = inner(label_class), inner(value_class)
    first = F.filter(F.transform(labels, lambda x, i: F.struct(x.alias("key"), F.coalesce(F.get(values, i), F.lit("")).alias("value"), i.alias("i"))), lambda e: F.array_position(labels, e.key) == e.i + 1)
    return F.map_from_entries(F.transform(first, lambda e: F.struct(e.key, e.value)))


def plain_text(html: Column) -> Column:
    """Text without tags; the five basic character references decoded."""
    text = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    pairs = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
    return squish(reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text))


def table_rows(df: DataFrame, html_col: str, columns: list[str], cell_tag: str = "td", row_tag: str = "tr") -> DataFrame:
    """A row for each table row with at least as many cells as columns, kept if its first or third column (number or title) isn't empty."""
    rows = df.select(*[c for c in df.columns if c != html_col], F.posexplode(_all(F.col(html_col), rf"(?is)<{row_tag}\b[^>]*>(.*?)</{row_tag}>", 1)).alias("row", "_tr"))
    cells = rows.withColumn("_cells", F.transform(_all(F.col("_tr"), rf"(?is)<{cell_tag}\b[^>]*>(.*?)</{cell_tag}>", 1), plain_text)).where(F.size("_cells") >= len(columns))
    out = cells.withColumns({c: F.get("_cells", F.lit(i)) for i, c in enumerate(columns)}).drop("_tr", "_cells")
    keep = [columns[0], *columns[2:3]]
    return out.where(reduce(lambda a, b: a | b, [F.col(c) != "" for c in keep]))


#: Where the fields of an API payload lie.
PAYLOAD_PATHS = {
    "id": "$.id", "title": "$.title", "status": "$.status.nameEn", "type": "$.type.key", "published": "$.publishDate", "due": "$.dueDate",
    "value_min": "$.valueRange.min", "value_max": "$.valueRange.max", "value_label": "$.valueRange.nameEn",
}


def flatten_payload(df: DataFrame, payload_col: str, url_template: str = "https://example.invalid/tenders/%s") -> DataFrame:
    """Payload variants to flat columns; the English category names as an array; items without an id are dropped."""
    v = F.col(payload_col)
    flat = df.withColumns({k: F.try_variant_get(v, p, "string") for k, p in PAYLOAD_PATHS.items()})
    names = F.from_json(F.to_json(F.try_variant_get(v, "$.categories", "variant")), "array<struct<name:struct<en:string>>>")
    flat = flat.withColumn("categories", F.filter(F.transform(names, lambda x: x["name"]["en"]), lambda x: x.isNotNull()))
    return flat.withColumn("url", F.format_string(url_template, "id")).where(F.coalesce(F.trim("id"), F.lit("")) != "").drop(payload_col)


def block_page_marker(c: Column | str, markers: list[str] | None = None) -> Column:
    """The first marker (in the list's order) that a page's text holds, lower-cased; null for a normal page."""
    low = F.lower(text_of(c))
    return F.coalesce(*[F.when(low.contains(m), F.lit(m)) for m in markers or BLOCK_MARKERS])


def block_page_flag(c: Column | str, markers: list[str] | None = None) -> Column:
    return block_page_marker(c, markers).isNotNull()


def page_is_stale(df: DataFrame, page: str, date: Column, target: Column) -> DataFrame:
    """One row for each page: stale if every record has a date and all are before the target day."""
    return df.groupBy(page).agg(F.bool_and(F.coalesce(date < target, F.lit(False))).alias("stale"))


def repeated_pages(df: DataFrame, source: str, page: str, pos: str, key: Column, title: Column, first: int = 5) -> DataFrame:
    """One row for each page with its fingerprint (first `first` keys and titles) and whether an earlier page had it."""
    w = Window.partitionBy(source, page).orderBy(pos)
    top = df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= first)  # at most `first` rows a page are gathered
    rows = top.groupBy(source, page).agg(F.array_sort(F.collect_list(F.struct("_n", key.alias("k"), title.alias("t")))).alias("_r"))
    prints = rows.withColumn("fingerprint", F.sha2(F.to_json(F.transform("_r", lambda x: F.struct(x.k, x.t))), 256)).drop("_r")
    seen = Window.partitionBy(source, "fingerprint").orderBy(page)
    return prints.withColumn("repeated", F.row_number().over(seen) > 1)


def page_novelty(df: DataFrame, source: str, page: str, pos: str, key: Column) -> DataFrame:
    """rows, new and duplicate counts of each page against the keys of earlier pages; blank keys are neither."""
    keyed = df.withColumn("_k", F.nullif(squish(key), F.lit("")))
    counts = keyed.groupBy(source, page).agg(F.count("*").alias("rows"), F.count("_k").alias("_keys"))
    # where a key comes first; blank ones, which may be very many, stay out
    first = keyed.where("_k is not null").groupBy(source, "_k").agg(F.min(F.col(page)).alias("_page")).groupBy(source, "_page").agg(F.count("*").alias("new_keys"))
    both = counts.join(first.withColumnRenamed("_page", page), [source, page], "left")
    new = F.coalesce("new_keys", F.lit(0))
    return both.select(source, page, "rows", new.alias("new_keys"), (F.col("_keys") - new).alias("duplicate_keys"))


def first_non_blank_key(*cols: Column | str) -> Column:
    return F.coalesce(*[F.nullif(squish(c), F.lit("")) for c in cols])


def parse_page_dates(c: Column) -> Column:
    """All dates of a text as dates, months in English or Arabic."""
    return F.transform(_all(english_months(squish(c)), f"({DATE_PATTERN})", 1), lambda x: F.to_date(F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in ("d MMM yyyy", "d MMMM yyyy", "d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd")])))
