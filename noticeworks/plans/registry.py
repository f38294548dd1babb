"""The registered queries over the given tables, with their SQL.

The driver tables stand in for notices: documents for texts by source (the first line is the title),
orders for dated and priced notices, events for snapshots and for a log of files, pages for captured
pages, conversations for lines. Every query runs over its whole tables. Matching of titles is about titles: its queries
take the first line of each document as its title, as short as a notice's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeworks.functions import dates, money, text
from noticeworks.operators import classify, extract, gold, identity, lexicon, mapping, match, profile, quality, upsert
from noticeworks.plans import medallion
from noticeworks.sources import bronze
from noticeworks.staging import staged

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers the function under its name."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(df: DataFrame) -> DataFrame:
    """df over all cores: a file of small rows is read by few tasks, and what the chain does with each row takes long."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def day(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


# ---------------------------------------------------------------- gold


def _notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as notices of their customer's nation; some lack a closing date."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    closing = F.when(F.col("o_orderkey") % 11 != 0, F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 60).cast("int")))
    return joined.select(
        F.col("o_orderkey").cast("string").alias("tender_id"), F.concat(F.lit("C-"), "o_orderkey").alias("tender_code"), F.col("o_orderpriority").alias("title"), F.to_date("o_orderdate").alias("published_date"),
        closing.alias("closing_date"), F.col("n_name").alias("country"), F.col("n_name").alias("source"), F.lit("").alias("source_url"),
        F.when(F.col("o_orderstatus") == "O", "Technology").when(F.col("o_orderstatus") == "P", "Review").otherwise("Non-Tech").alias("classification"),
    )


_NOTICES = """
with notices as (
    select o_orderkey, n_name, o_orderstatus, case when o_orderkey % 11 <> 0 then cast(o_orderdate as date) + cast(o_custkey % 60 as integer) end as closing,
           case o_orderstatus when 'O' then 'Technology' when 'P' then 'Review' else 'Non-Tech' end as cls
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
), gold as (
    select *, case when closing is null then 'Open' when closing >= date '1998-06-30' then 'Open' else 'Closed' end as status from notices
)
"""


@query(_NOTICES + "select n_name as source_name, status, count(*) as n from gold group by all")
def gold_status_counts(spark, sf_dir):
    g = gold.build_gold(_notices(spark, sf_dir), gold.as_of_date(override="1998-06-30"))
    return g.groupBy("source_name", "status").agg(F.count("*").alias("n"))


@query(_NOTICES + """
select 'source' as kind, n_name as value, count(*) as n, count(*) filter (closing is null and status = 'Open') as open_missing from gold group by n_name
union all select 'status', status, count(*), null from gold group by status
union all select 'classification', cls, count(*), null from gold group by cls
""")
def gold_summary(spark, sf_dir):
    return gold.gold_summary(gold.build_gold(_notices(spark, sf_dir), gold.as_of_date(override="1998-06-30")))


# ---------------------------------------------------------------- profiling


@query("""
select event_type, count(*) as rows, cast(5 as bigint) as columns, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000.0, 2) as span_hours, count(distinct user_id) as files,
       count(*) filter (trim(coalesce(props, '')) = '') as missing_cells, round(100.0 * count(*) filter (trim(coalesce(props, '')) = '') / (count(*) * 5), 2) as missing_percent,
       count(*) - count(distinct (event_id, ts, user_id, value, props)) as exact_duplicates, count(*) filter (trim(coalesce(props, '')) = '') as missing_titles
from events group by event_type
""")
def profile_4v(spark, sf_dir):
    out = profile.profile_4v(table(spark, sf_dir, "events"), "event_type", "ts", "user_id", ["title", "props"])
    return out.withColumns({"first_us": F.unix_micros("first_extracted"), "last_us": F.unix_micros("last_extracted")}).drop("first_extracted", "last_extracted")


@query("select source, count(*) - count(distinct (text, lang)) as exact_duplicates from documents group by source")
def exact_duplicate_rows(spark, sf_dir):
    return profile.exact_duplicates(table(spark, sf_dir, "documents"), "source", ["text", "lang"])


@query("""
select o_orderpriority, count(*) filter (o_orderkey % 3 = 0) + count(*) filter (o_orderkey % 5 = 0) as missing_cells,
       round(100.0 * (count(*) filter (o_orderkey % 3 = 0) + count(*) filter (o_orderkey % 5 = 0)) / (count(*) * 2), 2) as missing_percent
from orders group by 1
""")
def missing_cells(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderpriority", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("a"), F.when(F.col("o_orderkey") % 5 == 0, "  ").otherwise("x").alias("b"))
    return profile.missing_cells(o, "o_orderpriority", ["a", "b"])


@query("select event_type, list_sort(list(distinct k)) as columns from (select event_type, unnest(json_keys(props)) as k from events) group by 1")
def variety(spark, sf_dir):
    return profile.variety(table(spark, sf_dir, "events").select("event_type", F.try_parse_json("props").alias("rec")), "event_type")


# ---------------------------------------------------------------- texts

_TITLES = "titles as (select doc_id, source, lang, split_part(text, chr(10), 1) as title from documents)"
_KEY = "trim(regexp_replace(replace(lower(title), 'ß', 'ss'), '\\s+', ' ', 'g'))"


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.substring_index("text", "\n", 1).alias("title"))


_WHOLE = "titles as (select doc_id, source, lang, text as title from documents)"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.col("text").alias("title"))


@query(f"with {_WHOLE} select doc_id, {_KEY} as norm, regexp_replace({_KEY}, '[^\\p{{L}}\\p{{N}}]', '', 'g') as compact from titles")
def normalize_keys(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", text.norm_key("title").alias("norm"), text.compact_key("title").alias("compact"))


@query("select p_partkey, regexp_replace(regexp_replace(upper(p_brand || ' / ' || p_name), '[^A-Z0-9]+', '-', 'g'), '^-|-$', '', 'g') as token from part")
def display_tokens(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.display_token(F.concat_ws(" / ", "p_brand", "p_name")).alias("token"))


@query(f"""
with {_WHOLE}, odd as (select doc_id, case doc_id % 20 when 0 then ' N/A ' when 1 then '--' when 2 then 'Not   Available' else title end as t from titles)
select doc_id, case when doc_id % 20 >= 3 and lower(trim(t)) not in ('', '-', '--', '---', 'n/a', 'na', 'none', 'null', 'nan') then trim(regexp_replace(t, '\\s+', ' ', 'g')) end as cleaned from odd
""")
def null_like_clean(spark, sf_dir):
    k = F.col("doc_id") % 20
    odd = F.when(k == 0, " N/A ").when(k == 1, "--").when(k == 2, "Not   Available").otherwise(F.col("title"))
    return _texts(spark, sf_dir).select("doc_id", text.clean_text(odd).alias("cleaned"))


_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
_TOKENS = f"list_sort(list_distinct(list_filter(regexp_extract_all({_KEY}, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda w: length(w) >= 3 and w not in ({_STOP}))))"


@query(f"with {_WHOLE} select doc_id, array_to_string({_TOKENS}, ' ') as tokens, cast(len({_TOKENS}) as integer) as n from titles")
def title_tokens(spark, sf_dir):
    t = text.title_tokens("title")
    return _texts(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(t), " ").alias("tokens"), F.size(t).alias("n"))


@query("""
select o_orderkey, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(t, '[A-Z0-9]+(?:[-/][A-Z0-9]+){2,}'), lambda x: regexp_matches(x, '[0-9]')))), ' ') as refs
from (select o_orderkey, upper('Renewal of ab/' || o_custkey || '/' || year(o_orderdate) || ' and/or/else, see x-' || o_orderkey || '-y.') as t from orders)
""")
def external_refs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = F.concat(F.lit("Renewal of ab/"), "o_custkey", F.lit("/"), F.year("o_orderdate"), F.lit(" and/or/else, see x-"), "o_orderkey", F.lit("-y."))
    return o.select("o_orderkey", F.array_join(F.array_sort(text.external_refs(t)), " ").alias("refs"))


@query("select p_partkey, case when p_size % 3 = 0 then p_name end as found, case when p_size % 2 = 0 then 'https://x.example/' || replace(p_name, ' ', '%20') else 'https://own.example' end as url from part")
def pipe_fields_and_urls(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("Code | 7 | Name | "), "p_name", F.lit(" | End"))).otherwise("Code | 7")
    link = F.when(F.col("p_size") % 2 != 0, F.lit("https://own.example"))
    return p.select("p_partkey", text.pipe_field(raw, "name").alias("found"), text.build_url("https://x.example/", F.col("p_name"), link).alias("url"))


# ---------------------------------------------------------------- money and dates


@query("""
select l_orderkey, l_linenumber, l_partkey, cast(case when l_linenumber = 1 then -1 else 1 end * cast(round(l_extendedprice * 100) as bigint) / 100.0 as double) as amount from lineitem
""")
def parse_money_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    shown = F.concat(F.format_number(F.expr("cents div 100"), 0), F.lit("."), F.lpad((F.col("cents") % 100).cast("string"), 2, "0"), F.lit(" د.ك"))
    shown = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(shown)
    return li.withColumn("cents", cents).select("l_orderkey", "l_linenumber", "l_partkey", money.parse_money(shown).cast("double").alias("amount"))


@query("""
with cur as (select o_orderkey, o_totalprice, case c_nationkey % 7 when 0 then 'KWD' when 1 then 'QAR' when 2 then 'AED' when 3 then 'SAR' when 4 then 'OMR' when 5 then 'BHD' end as code from orders join customer on o_custkey = c_custkey),
rates(code, rate) as (values ('SAR', 1.00000), ('AED', 1.02916), ('QAR', 1.03020), ('BHD', 9.97231), ('OMR', 9.76628), ('KWD', 12.25170))
select o_orderkey, cur.code as currency_original, cast(round(cast(o_totalprice as decimal(20,6)) * cast(rate as decimal(10,5)), 2) as double) as amount_sar,
       case when rate is not null then 'SAR' end as currency
from cur left join rates on cur.code = rates.code
""")
def fx_to_base(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    names = F.create_map(*[F.lit(x) for kv in enumerate(["Kuwaiti Dinar", "qatar riyal", "aed", "SAR", "omr", "دينار بحريني"]) for x in kv])
    j = o.join(c, o.o_custkey == c.c_custkey).withColumn("code", money.normalize_currency(F.element_at(names, (F.col("c_nationkey") % 7).cast("int")), F.lit(None).cast("string")))
    amount = F.col("o_totalprice").cast("decimal(20,6)")
    return j.select("o_orderkey", F.col("code").alias("currency_original"), money.to_base_currency(amount, F.col("code")).cast("double").alias("amount_sar"), money.standard_currency(amount.isNotNull(), money.rate_of(F.col("code"))).alias("currency"))


@query("""
with cur as (select o_totalprice, case c_nationkey % 2 when 0 then 12.25170 else 1.02916 end as rate from orders join customer on o_custkey = c_custkey)
select cast(count(*) filter (abs(o_totalprice * rate - round(cast(o_totalprice as decimal(20,6)) * cast(rate as decimal(10,5)), 2)) > 0.0100001) as bigint) as sar_off from cur
""")
def conversion_check(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    code = F.when(F.col("c_nationkey") % 2 == 0, "KWD").otherwise("AED")
    j = o.join(c, o.o_custkey == c.c_custkey).select("o_totalprice", money.rate_of(code).cast("double").alias("fx_rate_to_sar"), money.to_base_currency(F.col("o_totalprice"), code).cast("double").alias("sar"))
    return mapping.check_conversion(j, [("o_totalprice", "sar")])


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders")
def date_multi_format(spark, sf_dir):
    """Every format of each source, some doubled as scrapers do, and formats of other sources that only the fallback reads."""
    o = table(spark, sf_dir, "orders").withColumn("source", F.element_at(F.array(*[F.lit(s) for s in dates.SOURCE_FORMATS]), (F.col("o_orderkey") % len(dates.SOURCE_FORMATS)).cast("int") + 1))
    shown, k = None, F.col("o_custkey")
    for name, formats in dates.SOURCE_FORMATS.items():
        x = F.when(k % 10 == 9, F.date_format("o_orderdate", "d.M.yyyy")).when(k % 10 == 8, F.concat_ws(" ", F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM-dd")))
        for i, f in enumerate(formats):
            x = x.when(k % len(formats) == i, F.date_format("o_orderdate", f))
        shown = F.when(F.col("source") == name, x) if shown is None else shown.when(F.col("source") == name, x)
    return o.select("o_orderkey", day(dates.parse_source_date(F.col("source"), shown)).alias("day"))


@query("select event_id, strftime(ts, '%Y-%m-%d') as day, strftime(ts + interval 3 hour, '%Y-%m-%d') as local_day from events")
def dotnet_and_free_dates(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    free = F.concat(F.lit("Published: "), F.date_format("ts", "d, MMM,yyyy"))
    ms = F.concat(F.lit("/Date("), F.unix_millis(F.col("ts").cast("timestamp")), F.lit(")/"))
    return e.select("event_id", day(dates.parse_any_date(free)).alias("day"), day(dates.dotnet_date(ms)).alias("local_day"))


# ---------------------------------------------------------------- quality and gates


@query("""
with m as (select l_shipdate < o_orderdate + interval 30 day as early, l_discount > 0.08 as cheap, l_tax = 0 as untaxed, l_quantity > 45 as bulk, o_orderpriority
           from lineitem join orders on l_orderkey = o_orderkey),
f as (select o_orderpriority, nullif(concat_ws('|', case when cheap then 'cheap' end, case when untaxed then 'untaxed' end), '') as crit,
             nullif(concat_ws('|', case when early then 'early' end, case when bulk then 'bulk' end), '') as warn from m)
select o_orderpriority, crit as critical_quality_flags, warn as warning_quality_flags, case when crit is null then 'PASS' else 'REJECT' end as quality_status, count(*) as n from f group by all
""")
def quality_flags(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    masks = {"early": F.col("l_shipdate") < F.col("o_orderdate") + F.expr("interval 30 days"), "cheap": F.col("l_discount") > 0.08, "untaxed": F.col("l_tax") == 0, "bulk": F.col("l_quantity") > 45}
    out = quality.with_quality(j, masks, ["cheap", "untaxed"], ["early", "bulk"])
    return out.groupBy("o_orderpriority", "critical_quality_flags", "warning_quality_flags", "quality_status").agg(F.count("*").alias("n"))


@query("""
select 'not_null:o_orderdate' as gate, count(*) filter (o_orderdate is null) as offences from orders
union all select 'unique:o_orderkey', count(*) - count(distinct o_orderkey) from orders
union all select 'unique:o_custkey', count(*) - count(distinct o_custkey) from orders
union all select 'allowed:o_orderstatus', count(*) filter (o_orderstatus not in ('O', 'F')) from orders
union all select 'non_blank:o_orderpriority', count(*) filter (trim(o_orderpriority) = '') from orders
union all select 'implies:urgent_is_dear', count(*) filter (o_orderpriority = '1-URGENT' and o_totalprice <= 100000) from orders
""")
def gates_report(spark, sf_dir):
    g = quality
    gates = [g.not_null("o_orderdate"), g.unique("o_orderkey"), g.unique("o_custkey"), g.allowed("o_orderstatus", ["O", "F"]), g.non_blank("o_orderpriority"), g.implies("urgent_is_dear", F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 100000)]
    return g.gates_report(table(spark, sf_dir, "orders"), gates)


# ---------------------------------------------------------------- classification

#: A small lexicon of words that the tables have, and rules of the query's own.
_LEXICON = {"tech": ["the and", "of the", "software", "database", "website development"], "nontech": ["in the", "brochure", "ring"], "override": ["that the", "cctv"], "weak": ["with", "für", "dans", "network"]}
_RULES = [("page_work", r"(?:make|paint)\w*", 60, "page"), ("tool_care", "oracle", 80, r"(?:help|care)\w*")]
_TRUSTED = classify.TRUSTED_CATEGORY


def _phrase_sql(name: str, col: str = "padded") -> str:
    ordered = sorted(_LEXICON[name], key=len, reverse=True)
    return "case " + " ".join(f"when contains({col}, ' {p.replace('ü', 'u')} ') then '{p}'" for p in ordered) + " end"


_norm_sql = lambda c: f"trim(regexp_replace(regexp_replace(strip_accents(replace(lower({c}), 'ß', 'ss')), '[-_/\\\\|(),:;.&+]+', ' ', 'g'), '\\s+', ' ', 'g'))"
_pad_sql = lambda c: f"' ' || regexp_replace({c}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g') || ' '"
_NORMED = f"""
with titles as (select doc_id, lang, case when doc_id % 10 = 5 then 'om_source_01' else source end as source, split_part(text, chr(10), 1) as title, case when instr(text, chr(10)) > 0 then substr(text, instr(text, chr(10)) + 1) else '' end as context from documents),
worded as (
    select * replace (case doc_id % 9 when 0 then 'Maker of a new page' when 1 then title || ' software' when 2 then 'ab' when 3 then 'Oracle helpers ' || title when 4 then 'Plain chairs' else title end as title) from titles
), normed as (select *, {_norm_sql("title")} as norm, {_norm_sql("context")} as ncontext from worded),
spaced as (select *, {_pad_sql("norm")} as padded, {_pad_sql("ncontext")} as cpadded from normed),
phrases as (select *, {_phrase_sql("override")} as override, {_phrase_sql("tech")} as tech, {_phrase_sql("nontech")} as nontech, {_phrase_sql("weak")} as weak, {_phrase_sql("tech", "cpadded")} as context_tech,
    case when regexp_matches(norm, '\\b(?:make|paint)\\w*\\b.{{0,60}}\\bpage\\b') then 'page_work'
         when regexp_matches(norm, '\\boracle\\b.{{0,80}}\\b(?:help|care)\\w*\\b') then 'tool_care' end as rule from spaced),
judged as (select doc_id, source, lang, case when length(norm) <= 2 then ['Review', 'bad_title', 'Missing or unusably short title']
    when override is not null then ['Non-Tech', 'nontech_override', override]
    when coalesce(tech, rule) is not null and nontech is not null and (coalesce(tech in ('software', 'website development'), false) or rule is not null) then ['Technology', 'tech_dominant', coalesce(tech, rule)]
    when coalesce(tech, rule) is not null and nontech is not null then ['Review', 'title_conflict', 'TECH=' || coalesce(tech, rule) || ' | NONTECH=' || nontech]
    when nontech is not null then ['Non-Tech', 'nontech_title_rule', nontech]
    when tech is not null then ['Technology', 'tech_title_rule', tech]
    when rule is not null then ['Technology', 'tech_title_regex', rule]
    when source = 'om_source_01' and doc_id % 4 < 2 then ['Technology', 'source_it_category', '{_TRUSTED}']
    when context_tech is not null then ['Review', 'tech_context_review', 'Technology evidence exists only in context: ' || context_tech]
    when weak is not null then ['Review', 'weak_tech_title_review', 'Possible Technology signal: ' || weak]
    else ['Non-Tech', 'no_tech_evidence', 'No Technology evidence detected'] end as j from phrases)
"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by their first line, with the rest of the text as context; a tenth are of the source whose category is trusted."""
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id") % 9
    title = F.substring_index("text", "\n", 1)
    worded = F.when(k == 0, "Maker of a new page").when(k == 1, F.concat(title, F.lit(" software"))).when(k == 2, "ab").when(k == 3, F.concat(F.lit("Oracle helpers "), title)).when(k == 4, "Plain chairs").otherwise(title)
    at = F.instr("text", "\n")
    t = d.select(
        "doc_id", "lang", F.when(F.col("doc_id") % 10 == 5, "om_source_01").otherwise(F.col("source")).alias("source"), worded.alias("title"), F.when(at > 0, F.substr("text", at + 1)).otherwise("").alias("context"),
        F.when(F.col("doc_id") % 4 < 2, f"a | {_TRUSTED} | b").alias("category"),
    )
    return classify.classify(spark, t, "source", "title", "context", "category", _LEXICON, _RULES)


@query(f"""with {_WHOLE}, normed as (select doc_id, {_norm_sql("title")} as norm from titles), spaced as (select doc_id, {_pad_sql("norm")} as padded from normed),
phrases as (select doc_id, {_phrase_sql("override")} as override, {_phrase_sql("tech")} as tech, {_phrase_sql("nontech")} as nontech, {_phrase_sql("weak")} as weak from spaced)
select doc_id, override, tech, nontech, weak from phrases where coalesce(override, tech, nontech, weak) is not null""")
def lexicon_first_match(spark, sf_dir):
    t = _texts(spark, sf_dir).select("doc_id", text.norm_match("title").alias("norm"))
    return lexicon.first_phrases(t, "doc_id", "norm", lexicon.compile_phrases(spark, _LEXICON), ["override", "tech", "nontech", "weak"])


#: Several hundred phrases: pairs of common words that texts may hold, by a rule.
_WORDS = "the and of to in that for with are this from was on it be by an at or not".split()
_MANY = [f"{a} {b}" for a in _WORDS for b in _WORDS if a != b]


@query(f"""with {_WHOLE}, normed as (select doc_id, {_norm_sql("title")} as norm from titles), spaced as (select doc_id, {_pad_sql("norm")} as padded from normed),
many(phrase) as (select unnest(string_split('{"|".join(_MANY)}', '|'))),
hits as (select doc_id, phrase from spaced join many on contains(padded, ' ' || phrase || ' ')),
lists as (select list(phrase order by length(phrase) desc, place) as p, doc_id from (select doc_id, phrase, list_position(string_split('{"|".join(_MANY)}', '|'), phrase) as place from hits) group by doc_id)
select doc_id, p[1] as tech from lists""")
def lexicon_of_hundreds(spark, sf_dir):
    t = _texts(spark, sf_dir).select("doc_id", text.norm_match("title").alias("norm"))
    return lexicon.first_phrases(t, "doc_id", "norm", lexicon.compile_phrases(spark, {"tech": _MANY}), ["tech"])


@query(_NORMED + "select doc_id, j[1] as classification, j[2] as method, j[3] as reason from judged")
def classify_cascade(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", "classification", "method", "reason")


@query(_NORMED + """select source, count(*) as total, count(*) filter (j[1] = 'Technology') as technology, count(*) filter (j[1] = 'Review') as review,
       count(*) filter (j[1] = 'Non-Tech') as non_tech, true as reconciled from judged group by source""")
def class_summary(spark, sf_dir):
    return classify.class_summary(_classified(spark, sf_dir), "source")


@query(_NORMED + "select source, j[2] as method, count(*) as n from judged group by all")
def class_methods(spark, sf_dir):
    return classify.method_summary(_classified(spark, sf_dir), "source")


@query(_NORMED + """, ranked as (select source, doc_id, j[1] as classification, row_number() over (partition by source, j[1] order by doc_id) as sample_no from judged)
select * from ranked where sample_no <= case classification when 'Non-Tech' then 8 else 12 end""")
def qa_sample(spark, sf_dir):
    return classify.qa_sample(_classified(spark, sf_dir), "source", ["doc_id"]).select("source", "doc_id", "classification", F.col("sample_no").cast("bigint").alias("sample_no"))


@query(_NORMED + """, ranked as (select source, doc_id, row_number() over (partition by source order by doc_id) as sample_no from judged where source in ('om_source_01', 'src8', 'src9', 'src10'))
select * from ranked where sample_no <= 5""")
def qa_sample_of_sources(spark, sf_dir):
    return classify.qa_sample_of_sources(_classified(spark, sf_dir), "source", ["doc_id"], ["om_source_01", "src8", "src9", "src10"]).select("source", "doc_id", F.col("sample_no").cast("bigint").alias("sample_no"))


@query(_NORMED + """select round(100.0 * count(*) filter (j[1] = 'Technology') / count(*), 2) as technology, round(100.0 * count(*) filter (j[1] = 'Review') / count(*), 2) as review,
       round(100.0 * count(*) filter (j[1] = 'Non-Tech') / count(*), 2) as non_tech from judged""")
def class_rates(spark, sf_dir):
    return classify.class_rates(_classified(spark, sf_dir))


# ---------------------------------------------------------------- identity

_KEYED = """
with k as (
    select o_orderkey, 'src' || left(o_orderpriority, 1) as src, case when o_orderkey % 10 <> 0 then 'id' || (o_orderkey // 2) else '' end as id,
           case when o_orderkey % 7 <> 0 then strftime(o_orderdate, '%Y-%m-%d') else '' end as pub, case when o_orderkey % 14 <> 0 then 'http://x/' || o_custkey else '' end as url, lower(o_orderstatus) as title
    from orders
), keyed as (
    select o_orderkey, case when id <> '' then src || '|source_id=' || id || case when pub <> '' then '|published=' || pub when url <> '' then '|url=' || url else '|title=' || title end
                            else src || '|title=' || title || '|published=' || pub || '|closing=|url=' || url end as business_key, src, id from k
)
"""


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(
        k, F.concat(F.lit("src_"), F.substring("o_orderpriority", 1, 1)).alias("source"), F.when(k % 10 != 0, F.concat(F.lit("ID/"), F.expr("o_orderkey div 2"))).alias("source_tender_id"),
        F.when(k % 7 != 0, F.to_date("o_orderdate")).alias("published_date"), F.lit(None).cast("date").alias("closing_date"), F.when(k % 14 != 0, F.concat(F.lit("http://x/"), "o_custkey")).alias("source_url"), F.col("o_orderstatus").alias("title"),
    )
    return identity.with_identity(o)


@query(_KEYED + "select o_orderkey, business_key, left(sha256(business_key), 24) as tender_id, 'TND-' || case when id <> '' then 'ID-' || substr(id, 3) || '-' else '' end || upper(left(sha256(business_key), 8)) as tender_code from keyed")
def business_key_ids(spark, sf_dir):
    return _keyed(spark, sf_dir).select("o_orderkey", "business_key", "tender_id", "tender_code")


@query(_KEYED + "select o_orderkey, case when id = '' then 1 else count(*) over (partition by src, id) end as source_id_group_size, case when id = '' then false else count(*) over (partition by src, id) > 1 end as source_id_reused from keyed")
def id_group_size(spark, sf_dir):
    return identity.id_group_size(_keyed(spark, sf_dir)).select("o_orderkey", "source_id_group_size", "source_id_reused")


@query("select o_custkey, count(distinct o_orderpriority) as keys from orders group by 1 having keys > 1")
def collision_report(spark, sf_dir):
    return identity.id_collisions(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query(f"select doc_id, row_number() over (partition by {_KEY.replace('title', 'text')}, lang order by n_chars desc nulls last, doc_id) as duplicate_rank from documents")
def exact_dedup(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    d = d.withColumn("fp", identity.record_fingerprint(d, ["text", "lang"]))
    return identity.rank_exact_duplicates(d, "fp", "n_chars", ["doc_id"]).select("doc_id", F.col("duplicate_rank").cast("bigint").alias("duplicate_rank"))


_DISPOSED = """
with f as (select *, value < 2 as bad, row_number() over (partition by user_id, event_type, floor(value / 50) order by ts desc, event_id) as dup from events),
s as (select *, row_number() over (partition by user_id, (not bad and dup = 1) order by ts desc, event_id) as rn from f),
d as (select event_id, event_type, case when bad then 'rejected' when dup > 1 then 'duplicate' when rn > 1 then 'superseded' else 'accepted' end as disposition from s)
"""


def _disposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumns({"bucket": F.floor(F.col("value") / 50), "quality_status": F.when(F.col("value") < 2, "REJECT").otherwise("PASS")})
    e = e.withColumn("fp", identity.record_fingerprint(e, ["user_id", "event_type", "bucket"]))
    ranked = identity.rank_exact_duplicates(e, "fp", "ts", ["event_id"])
    return identity.disposition(identity.collapse_snapshots(ranked, "user_id", "ts", (), ["event_id"]))


@query(_DISPOSED + "select event_id, disposition from d")
def snapshot_collapse(spark, sf_dir):
    return _disposed(spark, sf_dir).select("event_id", "disposition")


@query(_DISPOSED + """select count(*) as input, count(*) filter (disposition = 'rejected') as rejected, count(*) filter (disposition = 'duplicate') as duplicate,
       count(*) filter (disposition = 'superseded') as superseded, count(*) filter (disposition = 'accepted') as accepted, true as reconciled from d""")
def disposition_recon(spark, sf_dir):
    return identity.reconcile(_disposed(spark, sf_dir))


# ---------------------------------------------------------------- look-alikes


@query("""
with r as (select o_orderkey, o_orderpriority as s, 'CT/' || (o_custkey % 400) || '/' || year(o_orderdate) as ref from orders),
shared as (select ref from r group by ref having count(distinct s) > 1)
select o_orderkey, ref from r where ref in (select ref from shared)
""")
def shared_reference(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = F.concat(F.lit("Renewal of contract ct/"), F.col("o_custkey") % 400, F.lit("/"), F.year("o_orderdate"))
    return match.shared_reference_flags(o.select("o_orderkey", "o_orderpriority", text.external_refs(t).alias("refs")), "o_orderkey", "o_orderpriority", "refs")


_PAIRS = f"""
with {_TITLES}, tok as (select doc_id, source, lang, date '2026-01-01' + cast(doc_id % 20 as integer) as closing, {_TOKENS} as tokens from titles),
posts as (select lang, doc_id, source, unnest(tokens) as t from tok), rare as (select lang, t from posts group by all having count(*) >= 2),
kept as (select posts.* from posts join rare using (lang, t)),
cand as (select distinct a.doc_id as a, b.doc_id as b from kept a join kept b on a.lang = b.lang and a.t = b.t and a.doc_id < b.doc_id and a.source <> b.source),
pairs as (select cand.a, cand.b, cast(len(list_intersect(x.tokens, y.tokens)) as bigint) as shared, cast(len(x.tokens) + len(y.tokens) - len(list_intersect(x.tokens, y.tokens)) as bigint) as total, x.closing as ca, y.closing as cb
          from cand join tok x on cand.a = x.doc_id join tok y on cand.b = y.doc_id),
alike as (select a, b, shared, total, shared * 1.0 / total as similarity from pairs where shared * 1.0 / total >= 0.82 and abs(date_diff('day', ca, cb)) <= 7)
"""


def _tokenised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).withColumns({"tokens": text.title_tokens("title"), "closing": F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 20).cast("int"))})


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.similarity_reasons(_tokenised(spark, sf_dir), "doc_id", "source", "lang", "tokens", "closing")


@query(_PAIRS + "select a, b, shared, total from alike")
def title_similarity_pairs(spark, sf_dir):
    return match.similar_pairs(_tokenised(spark, sf_dir), "doc_id", "source", "lang", "tokens", "closing").select("a", "b", "shared", "total")


@query(_PAIRS + "select doc_id, doc_id in (select a from alike union all select b from alike) as possible_cross_source_duplicate from titles")
def similarity_flags(spark, sf_dir):
    none = _titles(spark, sf_dir).select("doc_id", F.lit("").alias("ref")).where("false")
    return match.spread_reasons(_titles(spark, sf_dir), "doc_id", none, _told(spark, sf_dir)).select("doc_id", "possible_cross_source_duplicate")


# ---------------------------------------------------------------- publishing

_HALVES = "with e as (select *, strftime(ts, '%Y-%m-%d') as d from events), old as (select * from e where event_id % 3 <> 0), new as (select * from e where event_id % 3 = 0)"


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "events").withColumn("d", day("ts"))
    return e.where("event_id % 3 <> 0"), e.where("event_id % 3 = 0")


@query(_HALVES + ", r as (select user_id, event_id, row_number() over (partition by user_id order by ts desc, d desc, (event_id % 3 = 0) desc) as n from e) select user_id, event_id from r where n = 1")
def upsert_newest_wins(spark, sf_dir):
    old, new = _halves(spark, sf_dir)
    return upsert.upsert(old, new, "user_id", "ts", "d").select("user_id", "event_id")


@query(_HALVES + """, o as (select user_id, max(ts) as t from old group by 1), n as (select user_id, max(ts) as t from new group by 1)
select count(*) filter (o.t is null) as inserted, count(*) filter (o.t is not null and n.t is not null) as matched, count(*) filter (n.t >= o.t) as updated, count(*) filter (n.t < o.t) as kept_existing_newer
from o full join n on o.user_id = n.user_id""")
def upsert_stats(spark, sf_dir):
    old, new = _halves(spark, sf_dir)
    return upsert.upsert_stats(old, new, "user_id", "ts", "d")


@query("""
select case event_type when 'view' then 'active' when 'click' then 'closed' when 'error' then 'unknown' when 'signup' then 'draft' else 'amended' end as source_status,
       case event_type when 'view' then ' Open' when 'click' then 'CLOSED' when 'error' then '(blanks)' when 'signup' then 'Draft' else 'Amended' end as raw_source_status, count(*) as n from events group by all
""")
def status_normalise(spark, sf_dir):
    t = F.col("event_type")
    raw = F.when(t == "view", " Open").when(t == "click", "CLOSED").when(t == "error", "(blanks)").when(t == "signup", "Draft").otherwise("Amended")
    return upsert.with_source_status(table(spark, sf_dir, "events").select(raw.alias("source_status"))).groupBy("source_status", "raw_source_status").agg(F.count("*").alias("n"))


@query("select p_partkey, case when p_size % 5 = 0 or p_type = 'PROMO' then 'عالمية (International)' else 'محلية (Local)' end as scope from part")
def scope_keyword(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") % 5 == 0, "Open INTERNATIONAL").otherwise(F.col("p_name"))
    return p.select("p_partkey", upsert.tender_scope(kind, F.when(F.col("p_type") == "PROMO", "External bid"), F.lit(None)).alias("scope"))


# ---------------------------------------------------------------- pages and records


@query("select page_id, case when contains(lower(html), 'forbidden') then 'forbidden' when contains(lower(html), 'ition') then 'ition' end as marker from pages")
def block_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", extract.block_page_marker("html", ["forbidden", "ition"]).alias("marker"))


@query("""
with navs as (select page_id, regexp_extract(html, '<ul>(.*?)</ul>', 1) as ul from pages),
links as (select page_id, regexp_extract_all(ul, '<a[^>]*>(.*?)</a>', 1) as l from navs)
select page_id, cast(0 as integer) as row, trim(l[1]) as first, trim(l[2]) as second, trim(l[3]) as third from links where len(l) >= 3 and (trim(l[1]) <> '' or trim(l[3]) <> '')
""")
def html_rows(spark, sf_dir):
    return extract.table_rows(table(spark, sf_dir, "pages").select("page_id", "html"), "html", ["first", "second", "third"], "a", "ul")


@query("""
select page_id, array_to_string(list_transform(regexp_extract_all(html, '<a[^>]*>(.*?)</a>', 1), lambda x: trim(x)), '|') as links from pages
""")
def page_link_texts(spark, sf_dir):
    found = F.regexp_extract_all("html", F.lit("<a[^>]*>(.*?)</a>"), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.transform(found, extract.plain_text), "|").alias("links"))


@query(r"""
with hits as (select conv_id, turn, unnest(regexp_extract_all(trim(regexp_replace(text, '\s+', ' ', 'g')), '[a-z]{6,} [a-z]{2,4} (?:the|and|de)')) as hit,
              generate_subscripts(regexp_extract_all(trim(regexp_replace(text, '\s+', ' ', 'g')), '[a-z]{6,} [a-z]{2,4} (?:the|and|de)'), 1) - 1 as pos from conversations)
select conv_id, turn, cast(pos as integer) as pos, split_part(hit, ' ', 1) as a, split_part(hit, ' ', 2) as b, split_part(hit, ' ', 3) as c from hits
""")
def records_from_text(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return extract.records_from_text(c, "text", "([a-z]{6,}) ([a-z]{2,4}) (the|and|de)", ["a", "b", "c"])


@query("""
with l as (select conv_id, role, row_number() over (partition by conv_id order by turn) as i from conversations),
firsts as (select conv_id, role, min(i) as i from l where role in ('user', 'assistant') group by all),
v as (select f.conv_id, f.role, case when n.role is null or n.role in ('user', 'assistant') then '' else n.role end as v from firsts f left join l n on n.conv_id = f.conv_id and n.i = f.i + 1)
select conv_id, max(v) filter (role = 'user') as after_user, max(v) filter (role = 'assistant') as after_assistant from v group by conv_id
union all select conv_id, null, null from conversations group by conv_id having count(*) filter (role in ('user', 'assistant')) = 0
""")
def label_value(spark, sf_dir):
    lines = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("l")).select("conv_id", F.transform("l", lambda x: x.role).alias("lines"))
    pairs = extract.label_value_pairs(F.col("lines"), ["user", "assistant"])
    return lines.withColumn("p", pairs).select("conv_id", F.element_at("p", F.lit("user")).alias("after_user"), F.element_at("p", F.lit("assistant")).alias("after_assistant"))


@query("select o_orderkey, strftime(o_orderdate + cast(o_custkey % 9 as integer) * interval 1 day, '%Y-%m-%d') as second_date, strftime(o_orderdate, '%d-%m-%Y') as close from orders")
def nth_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    later = F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 9).cast("int"))
    t = F.concat(F.lit("from "), F.date_format("o_orderdate", "d/M/yyyy"), F.lit(" to "), F.date_format(later, "yyyy-MM-dd"), F.lit(" end"))
    labelled = F.concat(F.lit("Sales end: 1-2-2020; Bid close: "), F.date_format("o_orderdate", "yyyy/M/d"))
    return o.select("o_orderkey", extract.nth_date(t, 1).alias("second_date"), extract.labelled_dates(labelled, "sales end", "bid close")["close"].alias("close"))


@query("select page_id, nullif(regexp_extract(url, 'https?://[^/]*/[a-z]*/([0-9]+)', 1), '') as id from pages")
def id_from_url(spark, sf_dir):
    number = F.regexp_extract("url", "https?://[^/]*/[a-z]*/([0-9]+)", 1)
    made = F.concat(F.lit("https://x.example/t?a=1&id=Tender%20%28"), number, F.lit("%29"))
    return table(spark, sf_dir, "pages").select("page_id", extract.id_from_url(made).alias("id"))


@query("""
with e as (select event_type as source, event_id // 40 as page, event_id as pos, user_id % 2 as k, user_id from events),
r as (select *, row_number() over (partition by source, page order by pos) as n from e),
p as (select source, page, string_agg(k || ':' || (k + 1), ',' order by n) as fp from r where n <= 5 group by all)
select source, page, row_number() over (partition by source, fp order by page) > 1 as repeated from p
""")
def repeated_pages(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.expr("event_id div 40").alias("page"), F.col("event_id").alias("pos"), (F.col("user_id") % 2).alias("k"))
    return extract.repeated_pages(e, "source", "page", "pos", F.col("k"), F.col("k") + 1).select("source", "page", "repeated")


@query("""
with e as (select event_type as source, event_id // 100 as page, event_id as pos, user_id from events), r as (select *, row_number() over (partition by source, user_id order by page, pos) as n from e)
select source, page, count(*) as rows, count(*) filter (n = 1) as new_keys, count(*) filter (n > 1) as duplicate_keys from r group by source, page
""")
def page_novelty(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.expr("event_id div 100").alias("page"), F.col("event_id").alias("pos"), "user_id")
    return extract.page_novelty(e, "source", "page", "pos", F.col("user_id"))


@query("select o_custkey, bool_and(coalesce(case when o_orderkey % 50 <> 0 then cast(o_orderdate as date) end < date '2000-06-01', false)) as stale from orders group by 1")
def stale_pages(spark, sf_dir):
    date = F.when(F.col("o_orderkey") % 50 != 0, F.to_date("o_orderdate"))
    return extract.page_is_stale(table(spark, sf_dir, "orders"), "o_custkey", date, F.lit("2000-06-01").cast("date"))


@query("""
select o_orderkey as page, 'Status' as label, o_orderstatus as value from orders union all select o_orderkey, 'Priority', o_orderpriority from orders
union all select o_orderkey, 'Customer', cast(o_custkey as varchar) from orders
""")
def cell_values(spark, sf_dir):
    """The value in the next cell, in the label's own, and below it."""
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "page")
    cell = lambda r, c, t: F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), t.cast("string").alias("text"))
    cells = F.array(cell(0, 0, F.lit("Status")), cell(0, 1, F.col("o_orderstatus")), cell(1, 0, F.concat(F.lit("Priority: "), "o_orderpriority")), cell(2, 3, F.lit("Customer")), cell(3, 3, F.col("o_custkey")))
    return extract.cell_label_values(o.select("page", F.inline(cells)), ["Status", "Priority", "Customer"])


@query("select event_id, cast(json_extract_string(props, '$.k') as varchar) as id, event_type as title, 'https://example.invalid/tenders/' || json_extract_string(props, '$.k') as url from events")
def json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rec = F.try_parse_json(F.concat(F.lit('{"id":'), F.get_json_object("props", "$.k"), F.lit(',"title":"'), "event_type", F.lit('"}')))
    return extract.flatten_payload(e.select("event_id", rec.alias("rec")), "rec").select("event_id", "id", "title", "url")


# ---------------------------------------------------------------- files


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return bronze.object_columns(e.select(F.concat_ws("/", "event_type", day("ts"), F.concat("event_id", F.when(F.col("event_id") % 50 == 0, "/x").otherwise(".json"))).alias("object_name"), "event_id", "user_id"))


_FILES = "with f as (select event_id, user_id, event_type as source, strftime(ts, '%Y-%m-%d') as d, event_type || '/' || strftime(ts, '%Y-%m-%d') || '/' || event_id || case when event_id % 50 = 0 then '/x' else '.json' end as object_name from events)"


@query(_FILES + " select object_name from f where event_id % 50 = 0")
def unexpected_objects(spark, sf_dir):
    return bronze.unexpected_objects(_files(spark, sf_dir))


@query(_FILES + " select object_name from f where event_id % 50 <> 0 and user_id % 2 = 1")
def incremental_select(spark, sf_dir):
    files = _files(spark, sf_dir).where("parts = 3")
    return bronze.select_incremental(files, files.where("user_id % 2 = 0")).select("object_name")


@query(_FILES + " select source, max(object_name) as object_name from f where event_id % 50 <> 0 group by source")
def latest_object(spark, sf_dir):
    return bronze.latest_object_per_source(_files(spark, sf_dir).where("parts = 3"))


@query("select distinct 'src' || n_nationkey % 30 as source from nation where 'src' || n_nationkey % 30 not in (select source from documents)")
def missing_sources(spark, sf_dir):
    expected = table(spark, sf_dir, "nation").select(F.concat(F.lit("src"), F.col("n_nationkey") % 30).alias("source"))
    return bronze.missing_sources(table(spark, sf_dir, "documents"), expected)


@query("select event_type as source, cast(user_id as varchar) as run_id, count(*) as paths, min(cast(event_id as varchar)) as first_object from events group by all having count(*) > 1")
def duplicate_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("run_id"), F.col("event_id").cast("string").alias("object_name"))
    return bronze.duplicate_runs(e)


@query("select event_type as source, count(*) as rows, cast(sum(user_id) as bigint) as keys from events where event_type in ('click', 'view') group by 1")
def changed_since_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    new = e.select(F.col("event_type").alias("source"), F.col("event_id").alias("pos"), "user_id", F.try_parse_json("props").alias("rec"))
    changed = F.when((F.col("source").isin("click", "view")) & (F.col("pos") % 100 < 50), F.try_parse_json(F.lit('{"k": -1}'))).otherwise(F.col("rec"))
    out = bronze.changed_since_latest(new.withColumn("rec", changed), new)
    return out.groupBy("source").agg(F.count("*").alias("rows"), F.sum("user_id").alias("keys"))


@query("""select o_orderpriority, count(*) as n from orders where o_orderkey % 4 <> 0 group by 1""")
def valid_records(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumns({"number": F.when(F.col("o_orderkey") % 4 == 0, "x").otherwise(F.concat(F.lit("N-"), "o_orderkey")), "title": F.col("o_orderpriority")})
    return extract.valid_record(o, "number", "title", r"N-\d+").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("select o_custkey, o_orderstatus, min(o_orderkey) as o_orderkey from orders group by all")
def first_per_key(spark, sf_dir):
    return extract.first_per_page_key(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "o_orderkey").select("o_custkey", "o_orderstatus", "o_orderkey")


# ---------------------------------------------------------------- the whole chain


def _as_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as scraped notices of two sources: each in a first run, a third of them unchanged and a third amended in a second run."""
    o = _dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    third, run = F.col("o_custkey") % 3, F.col("run")
    runs = F.when(third == 2, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2)))
    rows = o.withColumn("run", F.explode(runs))
    title = F.concat(F.lit("Supply of item "), "o_orderkey", F.when((run == 2) & (third == 1), F.lit(" amended")).otherwise(""))
    published = F.when(F.col("o_orderkey") % 13 == 0, F.lit("no date")).otherwise(F.date_format("o_orderdate", "d MMM yyyy"))
    rec = F.struct(
        F.concat(F.lit("T-"), "o_orderkey").alias("Item ID"), title.alias("Title"), published.alias("Published Date"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 20), "d MMM yyyy").alias("Closing Date"), F.concat(F.lit("http://x/"), "o_orderkey").alias("Detail URL"),
        F.concat(F.lit("2026-09-0"), run.cast("string"), F.lit("T00:00:00Z")).alias("_extracted_at"),
    )
    source = F.when(F.col("o_orderkey") % 2 == 0, "qa_source_03").otherwise("ae_source_02")
    name = F.concat(source, F.lit("/2026-09-0"), run.cast("string"), F.lit("/run"), run.cast("string"), F.lit(".json"))
    return rows.select(
        source.alias("source"), F.concat(F.lit("2026-09-0"), run.cast("string")).alias("run_date"), F.concat(F.lit("run"), run.cast("string")).alias("run_id"), name.alias("object_name"), name.alias("file_path"),
        F.col("o_orderkey").alias("pos"), F.lit(False).alias("malformed"), F.parse_json(F.to_json(rec)).alias("rec"),
    )


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bronze records of three sources, with money, Arabic field names, lacking fields and odd dates."""
    o = _dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"))
    k, third = F.col("o_orderkey"), F.col("o_orderkey") % 3
    shown = lambda fmt: F.date_format("o_orderdate", fmt)
    price = F.concat(F.format_number("o_totalprice", 2), F.lit(" only"))
    title = F.concat(F.lit("Works  "), k)
    common = [(F.col("o_custkey") % 7).alias("_page"), F.concat(shown("yyyy-MM-dd"), F.lit("T03:04:05+03:00")).alias("_extracted_at")]
    raw = F.concat(F.lit("Tender Number | x | Entity Name | Dept "), "o_custkey", F.lit(" | End"))
    kw = F.struct(
        F.concat(F.lit("K-"), k).alias("Tender Number"), F.when(k % 17 != 0, title).alias("Title"), F.when(k % 5 != 0, F.concat(F.lit("Entity "), "o_custkey")).alias("Entity Name"), raw.alias("raw_text"),
        F.when(k % 7 == 0, "no date").otherwise(shown("MMM d, yyyy")).alias("Open Date"), shown("MMMM d, yyyy").alias("Close Date"), price.alias("Document Price"), F.concat(F.lit("http://k/"), k).alias("Link"), *common,
    )
    qa = F.struct(
        F.concat(F.lit("Q-"), k).alias("رقم المناقصة"), title.alias("موضوع المناقصة"), F.lit(" N/A ").alias("الجهة"), shown("d/M/yyyy").alias("تاريخ الطرح"), F.concat(F.dayofmonth("o_orderdate"), F.lit(" "), _arabic_month(F.month("o_orderdate")), F.lit(" "), F.year("o_orderdate")).alias("تاريخ الإغلاق"),
        price.alias("قيمة الوثائق (رق)"), F.when(k % 2 == 0, "ريال قطري").otherwise("aed").alias("_currency"), *common,
    )
    sa = F.struct(F.concat(F.lit("S-"), k).alias("Item ID"), title.alias("Title"), F.lit("Ministry").alias("Agency"), shown("yyyy-MM-dd").alias("Published Date"), shown("yyyy-M-d").alias("Closing Date"), *common)
    name = F.when(third == 0, "kw_source_01").when(third == 1, "qa_source_01").otherwise("sa_source_01")
    rec = F.when(third == 0, F.to_json(kw)).when(third == 1, F.to_json(qa)).otherwise(F.to_json(sa))
    path = F.concat_ws("/", name, shown("yyyy-MM-dd"), F.concat(F.lit("r"), F.col("o_custkey") % 4, F.lit(".json")))
    return o.select(name.alias("source"), shown("yyyy-MM-dd").alias("run_date"), F.concat(F.lit("r"), F.col("o_custkey") % 4).alias("run_id"), path.alias("object_name"), path.alias("file_path"), k.alias("pos"), F.parse_json(rec).alias("rec"))


def _arabic_month(month: Column) -> Column:
    names = {v: k for k, v in dates.ARABIC_MONTHS.items()}
    english = "January February March April May June July August September October November December".split()
    return F.element_at(F.array(*[F.lit(names[m]) for m in english]), month)


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written between its heavy steps, as the chain does
    return quality.with_quality(staged(quality.clean(_standard(spark, sf_dir)), "cleaned"))


def _standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(mapping.standardise(_priced(spark, sf_dir)).drop("rec"), "standardised")


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows with their flags, and of the other columns those that the reports read: a table that is written keeps whatever it is given."""
    standard = staged(mapping.standardise(_priced(spark, sf_dir)).select(*quality.CLEANED_FROM), "standardised")
    return staged(quality.with_quality(quality.clean(standard)).select(*quality.REPORTED_FROM), "flagged")


_MAPPED = """
with o as (select *, o_orderkey % 3 as third, strftime(o_orderdate, '%Y-%m-%d') as d from orders),
m as (
    select o_orderkey, case third when 0 then 'kw_source_01' when 1 then 'qa_source_01' else 'sa_source_01' end as source,
           case third when 0 then 'K-' when 1 then 'Q-' else 'S-' end || o_orderkey as tender_number,
           case when third = 0 and o_orderkey % 17 = 0 then null else 'Works ' || o_orderkey end as title,
           case third when 0 then case when o_orderkey % 5 = 0 then 'Dept ' else 'Entity ' end || o_custkey when 2 then 'Ministry' end as authority,
           case when third = 0 and o_orderkey % 7 = 0 then null else d end as published, d as closing,
           case third when 0 then 'Kuwait' when 1 then 'Qatar' else 'Saudi Arabia' end as country,
           case when third = 0 then 'KWD' when third = 1 and o_orderkey % 2 = 0 then 'QAR' when third = 1 then 'AED' end as cur,
           case when third < 2 then o_totalprice end as fee_original, case third when 0 then 'http://k/' || o_orderkey end as source_url, o_custkey % 7 as page, 'r' || (o_custkey % 4) as run_id, d
    from o
), priced as (
    select m.*, round(cast(fee_original as decimal(20,6)) * cast(rate as decimal(10,5)), 2) as fee, rate
    from m left join (values ('AED', 1.02916), ('QAR', 1.03020), ('KWD', 12.25170)) r(code, rate) on cur = code
), flagged as (
    select *, nullif(concat_ws('|', case when title is null then 'missing_title' end, case when published is null then 'published_date_parse_failed' end), '') as crit,
           nullif(concat_ws('|', case when authority is null then 'missing_authority' end, case when source_url is null then 'missing_source_url' end), '') as warn from priced
)
"""


@query(_MAPPED + """select o_orderkey, source, tender_number, title, authority, published as published_date, closing as closing_date, country, cur as currency_original, fee_original as document_fee_original,
       cast(fee as double) as document_fee, case when fee is not null then 'SAR' end as currency, cast(rate as double) as fx_rate_to_sar, source_url, page as source_page, run_id as bronze_run_id, d as bronze_run_date,
       strftime(cast(d as date) - interval 1 day, '%Y-%m-%d') || ' ' || '00:04:05' as scraped, crit as critical_quality_flags, warn as warning_quality_flags from flagged""".replace("strftime(cast(d as date) - interval 1 day, '%Y-%m-%d') || ' ' || '00:04:05'", "d || ' 00:04:05'"))
def mapped_fields(spark, sf_dir):
    """Every value that the chain maps, cleans, converts and flags."""
    return _mapped(spark, sf_dir).select(
        F.col("pos").alias("o_orderkey"), "source", "tender_number", "title", "authority", day("published_date").alias("published_date"), day("closing_date").alias("closing_date"), "country", "currency_original", "document_fee_original", "document_fee",
        "currency", "fx_rate_to_sar", "source_url", "source_page", "bronze_run_id", "bronze_run_date", F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss").alias("scraped"), "critical_quality_flags", "warning_quality_flags",
    )


@query(_MAPPED + """select metric, cast(value as bigint) as value from (
    select count(*) as rows, count(title) as with_title, count(tender_number) as with_number, count(d) as with_published, count(closing) as with_closing, count(fee) as with_fee, count(case when source <> 'qa_source_01' then authority else 'N/A' end) as with_authority,
           count(source_url) as with_url, 0 as with_minimum, 0 as with_maximum, 0 as with_bond, count(rate) as with_rate, count(distinct source) as sources, count(distinct cur) as currencies from flagged)
    unpivot (value for metric in (rows, with_title, with_number, with_published, with_closing, with_fee, with_authority, with_url, with_minimum, with_maximum, with_bond, with_rate, sources, currencies))""")
def standardization_metrics(spark, sf_dir):
    return mapping.standardization_report(_standard(spark, sf_dir))


@query(_MAPPED + "select source, count(*) as rows, count(title) as with_title, count(tender_number) as with_number, count(*) as with_published, count(*) as with_closing, count(fee) as with_fee from flagged group by source")
def standardization_by_source(spark, sf_dir):
    return mapping.standardization_report(_standard(spark, sf_dir), "source")


@query(_MAPPED + "select source, tender_number, coalesce(title, '') as title, authority, cast(fee as double) as document_fee, case when fee is not null then 'SAR' end as currency, source_url from flagged where source = 'kw_source_01'")
def source_view(spark, sf_dir):
    """The raw columns of one source; titles squished for the comparison."""
    out = mapping.source_view(_standard(spark, sf_dir), "kw_source_01")
    return out.withColumn("title", text.squish("title")).drop("published_date_raw", "closing_date_raw")


@query(_MAPPED + """select metric, cast(value as bigint) as value from (
    select count(*) as rows, count(*) filter (crit is null) as passed, count(crit) as rejected, count(warn) as warned, count(*) filter (published is null) as missing_published_date, count(*) filter (title is null) as missing_title,
           count(*) filter (published is null) as published_date_parse_failed, count(*) filter (authority is null) as missing_authority, count(*) filter (source_url is null) as missing_source_url from flagged)
    unpivot (value for metric in (rows, passed, rejected, warned, missing_published_date, missing_title, published_date_parse_failed, missing_authority, missing_source_url))
    union all select unnest(['scraped_at_parse_failed', 'negative_monetary_value', 'tender_value_min_gt_max', 'money_missing_original_currency', 'money_missing_fx_rate', 'invalid_standard_currency', 'missing_tender_number', 'missing_closing_date', 'closing_date_parse_failed', 'closing_before_published']), 0""")
def cleaning_metrics(spark, sf_dir):
    return quality.cleaning_report(_flagged(spark, sf_dir))


@query(_MAPPED + "select o_orderkey, crit is null as passes, crit is not null or warn is not null as has_issue from flagged")
def quarantine_and_issues(spark, sf_dir):
    rows = _mapped(spark, sf_dir)
    on, aside = quality.quarantine(rows)
    both = on.select(F.col("pos").alias("o_orderkey"), F.lit(True).alias("passes")).unionByName(aside.select(F.col("pos").alias("o_orderkey"), F.lit(False).alias("passes")))
    issues = quality.issue_rows(rows).select(F.col("pos").alias("o_orderkey"), F.lit(True).alias("has_issue"))
    return both.join(issues, "o_orderkey", "left").fillna(False, ["has_issue"])


@query("select distinct 'src' || (o_custkey % 3) as source from orders where o_custkey % 3 <> 0")
def unmapped_sources(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("src"), F.col("o_custkey") % 3).alias("source"))
    return mapping.require_mapped(o, {"src0": {}})


@query("select 'a' || o_orderkey as k, o_custkey as v, cast(null as varchar) as w from orders union all select 'c' || c_custkey, null, c_mktsegment from customer")
def united_sources(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("a"), "o_orderkey").alias("k"), F.col("o_custkey").alias("v"))
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("k"), F.col("c_mktsegment").alias("w"))
    return mapping.union_sources(o, c)


# ---------------------------------------------------------------- records, one by one


@query("""
with o as (select o_orderkey as k, o_custkey as c, strftime(o_orderdate, '%d-%b-%Y') as d from orders)
select k, cast(0 as integer) as pos, 'AB-RFQ-' || k as number, 'Works ' || c as title, 'RFQ' as type, 'Active' as status, d || ' 9:10 AM' as posted, d || ' 10:00 AM' as opened, d || ' 1:30 PM' as closes from o
union all select k, 1, 'C2-ITT-' || c || '/A', 'Pipes RFP ' || k, 'ITT', 'Under Review', d || ' 9:10 AM', d || ' 9:10 AM', d || ' 11:59 PM' from o where k % 3 = 0
""")
def default_records(spark, sf_dir):
    """Records of the source's own shape, two on some pages, with line feeds and words between."""
    o, k, c, d = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey"), F.date_format("o_orderdate", "dd-MMM-yyyy")
    row = lambda *parts: F.concat_ws("\n ", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    at = lambda t: F.concat(d, F.lit(f" {t}"))
    one = row("Negotiations", F.concat(F.lit("AB-RFQ-"), k), F.concat(F.lit("Works  "), c), "RFQ", "Active", at("9:10 AM"), at("10:00 AM"), at("1:30 PM"))
    two = row("more", F.concat(F.lit("C2-ITT-"), c, F.lit("/A")), F.concat(F.lit("Pipes RFP "), k), "ITT", "Under Review", at("9:10 AM"), at("9:10 AM"), at("11:59 PM"), "end")
    return extract.records_from_text(o.select(k.alias("k"), F.when(k % 3 == 0, F.concat_ws("\n", one, two)).otherwise(one).alias("text")), "text")


@query("select o_orderkey, strftime(o_orderdate, '%d/%m/%Y') as deadline from orders where o_orderkey % 5 > 0 union all select o_orderkey, null from orders where o_orderkey % 5 = 0")
def arabic_deadlines(spark, sf_dir):
    """Deadlines behind each spelling of the label, on its line or on the next."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    letter = F.element_at(F.array(*[F.lit(x) for x in "xاأإآ"]), (k % 5 + 1).cast("int"))
    page = F.concat(F.lit("رقم\n1\n"), letter, F.lit("خر موعد للعطاء"), F.when(k % 2 == 0, " : ").otherwise("\n"), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit("\nend"))
    return o.select(k, extract.deadline_value(extract.lines_of(page)).alias("deadline"))


@query("""select o_orderkey, cast(o_custkey as varchar) as fee, strftime(o_orderdate, '%Y-%m-%d') as deadline, 'Works ' || o_custkey as subject, 'Pipes ' || o_orderstatus as before_date,
       case when o_orderkey % 3 = 0 then 'External' end as kind, case when o_orderkey % 3 = 0 then 'Ministry ' || o_orderstatus end as authority, case when o_orderkey % 3 = 0 then 'Line ' || o_custkey end as link,
       o_orderstatus as card, case when o_orderkey % 4 = 0 then 'c' || o_custkey when o_orderkey % 4 = 1 then 'o' || o_orderkey end as first_key from orders""")
def record_fields(spark, sf_dir):
    """Inline pairs, deadlines, number prefixes, titles before dates, rows split at a type, cards and first keys."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    page = F.concat(F.lit("Number\n7\nFee: "), "o_custkey", F.lit("\n"), F.when(k % 2 == 0, F.concat(F.lit("Closing Date: "), d)).otherwise(F.concat(F.lit("Deadline\n"), d)), F.lit("\nEnd"))
    parts = F.when(k % 3 == 0, F.array(F.lit("1 Sep 2026"), F.concat(F.lit("Line "), "o_custkey"), F.lit("2 Sep 2026"), F.lit("External"), F.lit("3 Sep 2026"), F.concat(F.lit("Ministry "), "o_orderstatus"))).otherwise(F.array(F.lit("none")))
    split = extract.split_row_at_type(parts, F.lit(" "))
    lines = extract.lines_of(page)
    card = F.concat(F.lit('<div><span class="l">State</span><b class="v">'), "o_orderstatus", F.lit("</b></div>"))
    return o.select(
        k, F.element_at(extract.inline_pairs(lines, ["Fee"]), F.lit("Fee")).alias("fee"), extract.deadline_value(lines).alias("deadline"),
        extract.strip_number_prefix(F.concat(F.lit("N"), k, F.lit(" - Works "), "o_custkey"), F.concat(F.lit("N"), k)).alias("subject"),
        extract.title_before_date(F.concat(F.lit("Pipes  "), "o_orderstatus", F.lit(" Qatar 1 Sep 2026 more"))).alias("before_date"),
        split["type"].alias("kind"), split["authority"].alias("authority"), split["subject"].alias("link"), F.element_at(extract.card_fields(card, "l", "v"), F.lit("State")).alias("card"),
        extract.first_non_blank_key(F.when(k % 4 == 0, F.concat(F.lit(" c"), "o_custkey")).otherwise(" "), F.when(k % 4 == 1, F.concat(F.lit("o"), k))).alias("first_key"),
    )


@query("select o_orderpriority, count(*) filter (o_orderkey % 3 <> 0 and o_custkey % 5 <> 0) as real_ones, count(*) filter (o_orderkey % 3 <> 0 or o_custkey % 5 <> 0) as identified from orders group by 1")
def kept_records(spark, sf_dir):
    """Ghosts (no opening date, or a label for a number) and records with neither id nor url go."""
    o = table(spark, sf_dir, "orders")
    opened, number = F.when(F.col("o_orderkey") % 3 != 0, F.lit("1 Sep 2026")), F.when(F.col("o_custkey") % 5 == 0, F.lit("Number")).otherwise("7")
    real = extract.drop_ghost_records(o.withColumns({"number": number, "opened": opened}), "number", "opened", ["Number"]).groupBy("o_orderpriority").agg(F.count("*").alias("real_ones"))
    known = o.withColumns({"id": F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("tender_"), "o_orderkey")).otherwise("tender_"), "url": F.when(F.col("o_custkey") % 5 != 0, "http://x").otherwise(" ")})
    named = extract.require_identity(known, "id", "url").groupBy("o_orderpriority").agg(F.count("*").alias("identified"))
    return real.join(named, "o_orderpriority")


@query("""select o_orderkey, case when o_orderkey % 3 = 0 then null else cast(o_custkey as double) + 0.5 end as number, case o_orderkey % 3 when 0 then 'United Arab Emirates' when 1 then 'Kuwait' else 'Elsewhere' end as country,
       case when o_orderkey % 4 < 3 then strftime(o_orderdate, '%Y-%m-%d') end as fallback, strftime(o_orderdate - interval 1 day, '%Y-%m-%d') as yesterday from orders""")
def scalar_repairs(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    shown = F.when(k % 4 == 0, F.date_format("o_orderdate", "yyyy/M/d")).when(k % 4 == 1, F.date_format("o_orderdate", "d.M.yyyy")).when(k % 4 == 2, F.date_format("o_orderdate", "d-MMM-yyyy")).otherwise("soon")
    country = F.when(k % 3 == 0, "UAE").when(k % 3 == 1, "kuwait").otherwise("Elsewhere")
    number = F.when(k % 3 == 0, "n/k").otherwise(F.concat(F.lit("  "), "o_custkey", F.lit(".5 ")))
    return o.select(k, money.safe_numeric(number).alias("number"), money.canonical_country(country).alias("country"), day(dates.date_fallback(shown)).alias("fallback"), day(dates.target_date(F.col("o_orderdate").cast("timestamp"))).alias("yesterday"))


# ---------------------------------------------------------------- publishing, as a whole


@query("""select event_id, user_id, cast(floor(value) as bigint) as whole, case event_type when 'view' then true when 'click' then true when 'error' then null else false end as flag, cast(null as varchar) as lacking from events""")
def conformed_types(spark, sf_dir):
    """Columns in the order and types of a schema; what can't be cast or isn't there is null."""
    from pyspark.sql.types import StructType

    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    odd = e.select("event_id", F.col("user_id").cast("string").alias("user_id"), F.floor("value").cast("string").alias("whole"), F.when(t == "view", " TRUE").when(t == "click", "yes").when(t != "error", "no").alias("flag"), "props")
    return upsert.conform(odd, StructType.fromDDL("event_id bigint, user_id bigint, whole bigint, flag boolean, lacking string"))


@query("with r as (select tid, event_id, row_number() over (partition by tid order by ts desc, d desc, event_id desc) as n from (select 'u' || user_id as tid, event_id, ts, strftime(ts, '%Y-%m-%d') as d from events)) select tid as tender_id, 'r1' as silver_run_id, 'v2' as schema_version from r where n = 1")
def rebuilt_with_versions(spark, sf_dir):
    """History as one batch, without working columns, with the run's versions."""
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("u"), "user_id").alias("tender_id"), F.col("ts").alias("scraped_at"), day("ts").alias("bronze_run_date"), F.lit("x").alias("tender_number"), F.lit("y").alias("source_record_json"))
    out = upsert.with_run_versions(upsert.drop_working_columns(upsert.rebuild(e)), "r1", "2026-09-24", "m1", "v2")
    return out.drop("scraped_at", "bronze_run_date", "silver_run_date", "model_version")


@query("""select 'unique:tender_id' as gate, 0 as offences union all select 'unique:tender_code', 0 union all select 'non_blank:tender_code', 0 union all select 'allowed:classification', 0
       union all select 'allowed:status', 0 union all select 'row_count', abs(count(*) - 7) from orders""")
def gold_gates_report(spark, sf_dir):
    g = gold.build_gold(_notices(spark, sf_dir), gold.as_of_date(override="1998-06-30"))
    return quality.gates_report(g, gold.gold_gates(7))


@query(_FILES + """, n as (select object_name, count(*) as n from f where event_id % 50 <> 0 and user_id % 3 <> 0 group by 1)
select source, f.object_name, cast(event_id as varchar) as run_id, coalesce(n, 0) as rows from f left join n on n.object_name = f.object_name where event_id % 50 <> 0""")
def manifest(spark, sf_dir):
    files = _files(spark, sf_dir)
    return bronze.bronze_manifest(files.where("parts = 3 and user_id % 3 <> 0").withColumn("malformed", F.lit(False)), files)


@query(_FILES + " select object_name, row_number() over (partition by source order by d, cast(event_id as varchar), object_name) as place from f where event_id % 50 <> 0")
def rebuild_order(spark, sf_dir):
    """Arrival of all files of each source, as a rebuild reads them."""
    files = bronze.select_rebuild(_files(spark, sf_dir).where("parts = 3"))
    return files.select("object_name", F.row_number().over(Window.partitionBy("source").orderBy("arrival")).cast("bigint").alias("place"))


@query("select event_type as source, cast(event_id as varchar) as object_name from events where user_id % 50 = 7")
def explicit_run(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), (F.col("user_id") % 50).cast("string").alias("run_id"), F.lit("2026-01-01").alias("run_date"), F.col("event_id").cast("string").alias("object_name"))
    return bronze.select_explicit_run(e, "7", e.select("source").distinct()).select("source", "object_name")


# ---------------------------------------------------------------- look-alikes, told


@query(_PAIRS + """, told as (select unnest([a, b]) as doc_id, 'high_title_similarity:' || printf('%.2f', similarity) as reason from alike),
by_ref as (select doc_id, 'shared_reference:' || ref as r from (select doc_id, 'AB/' || (doc_id % 50) || '/9' as ref, source from documents where doc_id % 3 = 0) x where ref in (select 'AB/' || (doc_id % 50) || '/9' from documents where doc_id % 3 = 0 group by 1 having count(distinct source) > 1)),
a as (select doc_id, string_agg(reason, '|' order by reason) as reasons from told group by 1)
select t.doc_id, concat_ws('|', r, reasons) as cross_source_duplicate_reason from titles t left join by_ref using (doc_id) left join a using (doc_id) where r is not null or reasons is not null""")
def look_alike_reasons(spark, sf_dir):
    t = _titles(spark, sf_dir)
    refs = t.where("doc_id % 3 = 0").select("doc_id", "source", text.external_refs(F.concat(F.lit("see ab/"), F.col("doc_id") % 50, F.lit("/9 now"))).alias("refs"))
    shared = match.shared_reference_flags(refs, "doc_id", "source", "refs")
    told = match.spread_reasons(t, "doc_id", shared, _told(spark, sf_dir))
    return told.where("possible_cross_source_duplicate").select("doc_id", "cross_source_duplicate_reason")


_FINAL = "select event_id, event_type, user_id, case when value < 2 then 'rejected' when event_id % 7 = 0 then 'superseded' else 'accepted' end as disposition, user_id % 4 = 0 as alike, event_id % 5 = 0 as lacks from events"


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as disposed rows."""
    e, lacks = table(spark, sf_dir, "events"), F.col("event_id") % 5 == 0
    some = lambda c: F.when(~lacks, c)
    return e.select(
        F.concat(F.lit("t"), "user_id").alias("tender_id"), F.lit("c").alias("tender_code"), F.col("event_type").alias("source"), F.lit("Oman").alias("country"), some(F.col("event_type")).alias("title"), F.to_date("ts").alias("closing_date"), some(F.to_date("ts")).alias("published_date"),
        F.when(F.col("value") < 2, "rejected").when(F.col("event_id") % 7 == 0, "superseded").otherwise("accepted").alias("disposition"), F.when(F.col("value") < 2, "REJECT").otherwise("PASS").alias("quality_status"), (F.col("user_id") % 4 == 0).alias("possible_cross_source_duplicate"),
        F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("r"), "user_id")).alias("cross_source_duplicate_reason"), F.lit(True).alias("source_id_reused"), F.lit("Review").alias("classification"), lacks.alias("has_quality_warning"), F.lit(None).cast("double").alias("document_fee"), some(F.lit("a")).alias("authority"), F.lit("n").alias("tender_number"),
        F.lit("r").alias("bronze_run_id"), F.lit("p").alias("bronze_file_path"), "event_id", F.lit("d").alias("run_date"),
    )


@query(f"""with e as ({_FINAL}) select metric, cast(value as bigint) as value from (
    select count(*) as input, count(*) filter (disposition = 'accepted') as accepted, count(*) filter (disposition = 'rejected') as rejected, count(*) filter (disposition = 'superseded') as superseded, count(distinct user_id) as distinct_ids, count(*) as reused_ids,
           count(*) filter (alike) as look_alikes, count(*) as review, count(*) filter (lacks) as warned, count(*) filter (disposition = 'rejected') as not_passed, count(*) filter (lacks) as missing_title, count(*) filter (lacks) as missing_authority, count(*) as with_closing,
           count(*) filter (not lacks) as with_published, count(distinct event_type) as sources, 1 as countries, 1 as runs, 1 as files from e)
    unpivot (value for metric in (input, accepted, rejected, superseded, distinct_ids, reused_ids, look_alikes, review, warned, not_passed, missing_title, missing_authority, with_closing, with_published, sources, countries, runs, files))
    union all select unnest(['duplicate', 'technology', 'non_tech', 'missing_tender_id', 'missing_source', 'missing_country', 'missing_tender_number', 'with_fee']), 0""")
def final_metrics(spark, sf_dir):
    return match.final_quality_report(_final(spark, sf_dir))


@query(f"with e as ({_FINAL}) select 't' || user_id as tender_id, 'r' || user_id as cross_source_duplicate_reason, count(*) as n from e where alike group by all")
def possible_duplicates(spark, sf_dir):
    return match.possible_duplicates(_final(spark, sf_dir)).groupBy("tender_id", "cross_source_duplicate_reason").agg(F.count("*").alias("n"))


@query(f"with e as ({_FINAL}) select 't' || user_id as tender_id, min(event_id) as event_id from e group by all")
def first_of_each_id(spark, sf_dir):
    return match.representatives(_final(spark, sf_dir), "tender_id", ["run_date", "event_id"]).select("tender_id", "event_id")


@query("""
with r as (
    select case o_orderkey % 3 when 0 then 'kw_source_01' when 1 then 'qa_source_01' else 'sa_source_01' end as source, strftime(o_orderdate, '%Y-%m-%d') as d, o_custkey % 4 as run,
           o_orderkey % 3 = 0 and o_orderkey % 17 = 0 as untitled, o_orderkey % 3 = 0 and o_orderkey % 5 = 0 as without_entity from orders
), s as (
    select source, count(*) as rows, date_diff('day', cast(min(d) as date), cast(max(d) as date)) * 24.0 as hours, count(distinct d || run) as files, count(*) filter (untitled) as untitled, count(*) filter (without_entity) as without from r group by source
), k as (
    select *, case source when 'kw_source_01' then 'Close Date|Document Price|Entity Name|Link|Open Date|Tender Number|Title|_extracted_at|_page|raw_text' when 'qa_source_01' then '_currency|_extracted_at|_page|الجهة|تاريخ الإغلاق|تاريخ الطرح|رقم المناقصة|قيمة الوثائق (رق)|موضوع المناقصة' else 'Agency|Closing Date|Item ID|Published Date|Title|_extracted_at|_page' end as keys from s
)
select source, rows, cast(len(string_split(keys, '|')) as bigint) as columns, keys, cast(hours as double) as span_hours, files, untitled + without as missing_cells,
       round(100.0 * (untitled + without) / (rows * len(string_split(keys, '|'))), 2) as missing_percent, 0 as exact_duplicates, untitled as missing_titles from k
""")
def profile_of_records(spark, sf_dir):
    """The 4V profile over records: each source's own keys, and keys that a record lacks."""
    out = profile.profile_records(_priced(spark, sf_dir), "source", ["_extracted_at"], mapping.TITLE_FIELDS, "object_name")
    return out.drop("first_extracted", "last_extracted").withColumn("keys", F.array_join("keys", "|"))


@query(_MAPPED + """select source, count(*) as rows, count(*) filter (crit is null) as passed, count(crit) as rejected, count(warn) as warned, count(*) filter (published is null) as missing_published_date, count(*) filter (title is null) as missing_title,
       count(*) filter (published is null) as published_date_parse_failed, count(*) filter (authority is null) as missing_authority, count(*) filter (source_url is null) as missing_source_url, 0 as scraped_at_parse_failed, 0 as negative_monetary_value,
       0 as tender_value_min_gt_max, 0 as money_missing_original_currency, 0 as money_missing_fx_rate, 0 as invalid_standard_currency, 0 as missing_tender_number, 0 as missing_closing_date, 0 as closing_date_parse_failed, 0 as closing_before_published from flagged group by source""")
def cleaning_by_source(spark, sf_dir):
    return quality.cleaning_report(_flagged(spark, sf_dir), "source")


#: Rows in which every predicate of quality is true now and then: (column, when it is set, its value).
@query("""
with e as (select event_id as k, event_id % 2 = 0 as a, event_id % 3 = 0 as b, event_id % 5 = 0 as c, event_id % 7 = 0 as f, event_id % 11 = 0 as g, event_id % 13 = 0 as h from events)
select k, nullif(concat_ws('|', case when a then 'missing_title' end, case when b then 'published_date_parse_failed' end, case when c then 'scraped_at_parse_failed' end, case when f then 'negative_monetary_value' end, case when g then 'tender_value_min_gt_max' end,
           case when h then 'money_missing_original_currency' end, case when h or f and g then 'money_missing_fx_rate' end, case when h and a then 'invalid_standard_currency' end), '') as critical,
       nullif(concat_ws('|', case when b and c then 'missing_tender_number' end, case when a and c then 'missing_authority' end, case when f then 'missing_closing_date' end, case when g then 'missing_source_url' end, case when f and a then 'closing_date_parse_failed' end,
           case when not f and not b and c then 'closing_before_published' end), '') as warning from e
""")
def every_quality_flag(spark, sf_dir):
    k = F.col("event_id")
    a, b, c, f, g, h = (k % n == 0 for n in (2, 3, 5, 7, 11, 13))
    text_if = lambda good, value: F.when(good, F.lit(value))
    rows = table(spark, sf_dir, "events").select(
        k.alias("k"), text_if(~a, "title").alias("title"), F.lit("2026-01-05").alias("published_date_raw"), F.when(~b, F.lit("2026-01-05").cast("date")).alias("published_date"), F.lit("x").alias("scraped_at_raw"), F.when(~c, F.lit("2026-01-05").cast("timestamp")).alias("scraped_at"),
        F.when(f, F.lit(-1.0)).otherwise(1.0).alias("document_fee"), F.when(f, F.lit(-1.0)).otherwise(1.0).alias("document_fee_original"), F.when(g, F.lit(9.0)).otherwise(1.0).alias("tender_value_min_original"), F.lit(2.0).alias("tender_value_max_original"), F.when(g, F.lit(9.0)).otherwise(1.0).alias("tender_value_min_sar"), F.lit(2.0).alias("tender_value_max_sar"),
        F.lit(None).cast("double").alias("temporary_bond_original"), F.lit(None).cast("double").alias("temporary_bond_sar"), text_if(~h, "SAR").alias("currency_original"), F.when(~(h | (f & g)), F.lit(1.0)).alias("fx_rate_to_sar"), text_if(~(h & a), "SAR").alias("currency"),
        text_if(~(b & c), "n").alias("tender_number"), text_if(~(a & c), "x").alias("authority"), text_if(~g, "u").alias("source_url"), text_if(~(f & ~a), "2026-01-01").alias("closing_date_raw"),
        F.when(~f, F.when(c, F.lit("2026-01-01").cast("date")).otherwise(F.lit("2026-02-01").cast("date"))).alias("closing_date"),
    )
    return quality.with_quality(rows).select("k", F.col("critical_quality_flags").alias("critical"), F.col("warning_quality_flags").alias("warning"))


@query("""select o_orderkey, case when o_orderkey % 5 = 0 then 'Second ' || o_custkey else 'First ' || o_orderkey end as title,
       concat_ws(' | ', o_orderstatus, case when o_orderkey % 4 <> 0 then 'true' end, 'k' || o_custkey, cast(o_orderkey as varchar), trim(o_orderpriority)) as context from orders""")
def nested_context(spark, sf_dir):
    """Leaf texts of nested records, joined; the first title that isn't blank."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    first = F.when(k % 5 == 0, F.when(k % 2 == 0, F.lit("  "))).otherwise(F.concat(F.lit(" First "), k, F.lit(" ")))
    lists = F.array(F.struct(F.array(F.col("o_orderstatus"), F.lit(" ")).alias("inner"), F.when(k % 4 != 0, F.lit(True)).alias("on")))
    deep = F.struct(F.struct(F.concat(F.lit("k"), "o_custkey").alias("a"), k.alias("b")).alias("x"))
    rec = F.parse_json(F.to_json(F.struct(first.alias("Title"), F.concat(F.lit("Second "), "o_custkey").alias("Other"), lists.alias("list"), deep.alias("deep"), F.col("o_orderpriority").alias("plain"))))
    get = lambda f: F.try_variant_get("rec", f"$.{f}", "string")
    leaves = lambda f: text.leaf_texts(F.try_variant_get("rec", f"$.{f}", "variant"))
    return o.select("o_orderkey", rec.alias("rec")).select("o_orderkey", text.first_text(get("Title"), get("Other")).alias("title"), text.context_text([leaves(f) for f in ("list", "absent", "deep", "plain")]).alias("context"))


@query(f"""with e as ({_FINAL}) select 'r9' as run_id, count(*) as rows, count(distinct event_type) as sources, 1 as countries, 1 as bronze_runs, 'd' as first_run_date, 'd' as last_run_date,
    count(*) filter (lacks) as warned, count(*) filter (alike) as look_alikes, 0 as technology, count(*) as review, 0 as non_tech, 0 as with_fee, 'm1' as model_version, '2' as schema_version from e where disposition = 'accepted'""")
def run_summary_row(spark, sf_dir):
    """What a run says of the rows that it publishes."""
    rows = _final(spark, sf_dir).where("disposition = 'accepted'")
    published = upsert.with_run_versions(rows.withColumns({"bronze_run_date": F.col("run_date"), "scraped_at": F.lit(None).cast("timestamp")}), "r9", "2026-09-24", "m1", "2")
    return upsert.run_summary(published, "r9").drop("first_scraped", "last_scraped")


@query("""
with r as (select o_orderkey, o_custkey % 3 as third, o_orderkey % 13 = 0 as bad, case when o_orderkey % 2 = 0 then 'qa_source_03' else 'ae_source_02' end as source, unnest(case when o_custkey % 3 = 2 then [1] else [1, 2] end) as run from orders)
select source, case when bad then 'rejected' when third = 0 and run = 1 then 'duplicate' when third = 1 and run = 1 then 'superseded' else 'accepted' end as disposition, 'Non-Tech' as classification, count(*) as n
from r group by all
""")
def medallion_dispositions(spark, sf_dir):
    rows = medallion.silver_rows(spark, _as_bronze(spark, sf_dir), medallion.Run("r1", "2026-09-24"))
    return rows.groupBy("source", "disposition", "classification").agg(F.count("*").alias("n"))
