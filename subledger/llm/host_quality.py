"""Operator 8, quality rules at host level: rule failures per host, shrunk with an empirical beta prior.

Every text gets word, symbol, line and repetition counts (built-in functions only, inside the row: nothing is
exploded or shuffled). Documents that fail any rule are counted per host (``source``). A host's raw rate is
unsure when it has few documents, so it is shrunk: the prior Beta(a, b) is fitted to all hosts' rates by the
method of moments, net of the binomial noise that rates of so few documents have anyway, and the host's rate becomes
(failures + a) / (documents + a + b). A host is blocked when this rate lies surely (by SURE posterior standard
deviations) above TOLERATED; the verdict is joined back: a document is rejected if it fails a base rule, or
if its host is blocked and it fails a content rule itself (symbols, word length; a repeated line or passage alone is
no ground). A clean page of a bad host stays.

Shuffles: one partial aggregate per host (a hot host is one row per task) and the join on the host, which has
one row per host on one side. Where rows with their texts are filtered, only those that fail a content rule are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, stored, words

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
WINDOW = 8
TOLERATED, SURE = 0.125, 1.645  # one failing document in eight; one-sided 95 per cent
MAX_STRENGTH = 1e6  # of the prior, where the hosts' rates do not differ


def repeated_window_words(word_list: Column) -> Column:
    """How many words lie in a WINDOW-word run that stands twice or more in the list (first one included)."""

    def covered(spots: Column) -> Column:
        zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))

        def step(acc, p):
            return F.struct((acc["words"] + p + WINDOW - F.greatest(p, acc["end"])).alias("words"),
                            (p + WINDOW).alias("end"))

        return F.aggregate(spots, zero, step, lambda acc: acc["words"])

    def repeats(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def spots(p: Column) -> Column:
            marked = F.transform(p, lambda x, i: F.when(
                (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"]), x["i"]))
            return covered(F.sort_array(F.array_compact(marked)))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(bind(placed, spots))

    def windows(hashed: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashed) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashed, i, WINDOW)))

    hashed = F.transform(word_list, lambda w: F.xxhash64(w))
    return F.when(F.size(word_list) <= WINDOW, 0).otherwise(
        bind(hashed, lambda h: bind(windows(h), repeats))).cast("long")


def quality(text: Column) -> Column:
    """Struct of a whole text's counts and rule outcomes (NULL: as the empty text)."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")

    def counted(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_window_words(w).alias("n_repeat_words"))

    def signs() -> Column:
        return F.struct(F.length(F.translate(text, BLANKS, "")).cast("long").alias("chars"),
                        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("symbols"))

    def told(c: Column) -> Column:
        n, repeat = c["n_words"], c["n_repeat_words"]

        def ruled(s: Column, x: Column) -> Column:
            chars, symbols = s["chars"], s["symbols"]
            repeated_lines = F.size(x) - F.size(F.array_distinct(x))
            return bind(repeated_lines, lambda dup: F.struct(
                n.alias("n_words"), chars.alias("word_chars"), symbols.alias("n_symbols"),
                dup.cast("long").alias("n_dup_lines"), repeat.alias("n_repeat_words"),
                ((n < 20) | (100 * repeat > 30 * n)).alias("base_failed"),
                # the soft rules: symbols, word length, repeated lines, repeated runs
                ((100 * symbols > 10 * chars).cast("int")
                 + ((chars < 2 * n) | (chars > 15 * n)).cast("int")
                 + (10 * dup > 3 * F.size(x)).cast("int")
                 + (100 * repeat > 15 * n).cast("int")).alias("rule_failures"),
                ((100 * symbols > 10 * chars).cast("int") + ((chars < 2 * n) | (chars > 15 * n)).cast("int"))
                .alias("content_failures")))

        return bind(signs(), lambda s: bind(lines, lambda x: ruled(s, x)))

    return bind(bind(words(text), counted), told)


def host_verdicts(facts: DataFrame) -> DataFrame:
    """(host, host_rate, host_verdict) from rows of (host, q); q as made by :func:`quality`."""
    failed = (F.col("q.base_failed") | (F.col("q.rule_failures") > 0)).cast("long")
    hosts = facts.groupBy("host").agg(F.sum(failed).alias("failed"), F.count("*").alias("docs"))
    rate = F.col("failed") / F.col("docs")
    m, v, e = F.col("m"), F.col("v"), F.col("e")
    # var(rate) = m (1 - m) (rho + (1 - rho) mean(1 / docs)); the prior's strength is 1 / rho - 1
    rho = (v / (m * (1 - m)) - e) / (1 - e)
    least = F.lit(1 / (1 + MAX_STRENGTH))
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg(F.lit(1.0) / F.col("docs")).alias("e")).select(
        F.struct(m, F.when((m > 0) & (m < 1) & (e < 1), F.lit(1.0) / F.greatest(least, F.least(F.lit(0.999999), rho)) - 1)
                 .otherwise(MAX_STRENGTH).alias("s"))).scalar()
    shrunk = (F.col("failed") + prior["m"] * prior["s"]) / (F.col("docs") + prior["s"])
    spread = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("docs") + prior["s"] + 1))
    return (hosts.select("host", "docs", F.round(shrunk, 9).alias("host_rate"))
            .select("host", "host_rate", F.when(F.col("host_rate") - SURE * spread > TOLERATED, "block").otherwise("allow")
                    .alias("host_verdict")))


def _judged(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """Rows of (.., host, q) with the host columns and ``kept``."""
    hosts = hosts.withColumnRenamed("host", "of_host")
    kept = ~F.col("q.base_failed") & ~((F.col("host_verdict") == "block") & (F.col("q.content_failures") > 0))
    return rows.join(hosts, rows["host"].eqNullSafe(hosts["of_host"])).drop("of_host").withColumn("kept", kept)


def op8_host_rules(docs: DataFrame) -> DataFrame:
    """Contract rows plus rule_failures, content_failures, host_rate, host_verdict.

    NULL text counts as empty (no words: base_failed). Rows without a source form one host of their own.
    Repeated rows are judged each. An empty table gives an empty result."""
    facts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("host"),
                               quality(F.col("text")).alias("q")), "quality")
    return _judged(facts, host_verdicts(facts)).select(
        "doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words",
        "q.base_failed", "kept", "q.rule_failures", "q.content_failures", "host_rate", "host_verdict")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` that the verdict keeps. The rows are written once with their counts, as
    the host rates and the verdicts both read them."""
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                              F.col("source").alias("host"), quality(F.col("text")).alias("q")), "judged")
    sound = rows.where("not q.base_failed")
    blocked = host_verdicts(rows).where("host_verdict = 'block'").select(F.col("host").alias("of_host"))
    doubtful = sound.where("q.content_failures > 0").join(
        blocked, F.col("host").eqNullSafe(F.col("of_host")), "left_anti")
    return sound.where("q.content_failures = 0").unionByName(doubtful).select("row.*")


ORACLE = r"""
with w as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), win as (
  select r, len(ws) as n, unnest(range(1, len(ws) - 6)) as i, ws from w where len(ws) >= 8
), gram as (select r, i, array_to_string(ws[i:i+7], ' ') as g from win),
rep as (select r, i from (select r, i, count(*) over (partition by r, g) as c from gram) where c > 1),
cover as (select r, sum(least(8, coalesce(nxt - i, 8))) as n_repeat from
  (select r, i, lead(i) over (partition by r order by i) as nxt from rep) group by r),
lines as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup from
    (select r, unnest(string_split(text, chr(10))) as line from w)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r
), q as (
  select w.r, doc_id, source, cast(len(ws) as bigint) as n_words,
         cast(length(array_to_string(ws, '')) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(n_dup, 0) as bigint) as n_dup_lines, coalesce(n_lines, 0) as n_lines,
         cast(coalesce(n_repeat, 0) as bigint) as n_repeat_words
  from w left join lines using (r) left join cover using (r)
), ruled as (
  select *, (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed,
    cast(100 * n_symbols > 10 * word_chars as int) + cast(word_chars < 2 * n_words or word_chars > 15 * n_words as int)
    + cast(10 * n_dup_lines > 3 * n_lines as int) + cast(100 * n_repeat_words > 15 * n_words as int) as rule_failures,
    cast(100 * n_symbols > 10 * word_chars as int)
    + cast(word_chars < 2 * n_words or word_chars > 15 * n_words as int) as content_failures
  from q
), hosts as (
  select source, sum(case when base_failed or rule_failures > 0 then 1 else 0 end) as failed, count(*) as docs
  from ruled group by source
), prior as (
  select m, case when m > 0 and m < 1 and e < 1 then
    1.0 / greatest(1.0 / (1 + 1e6), least(0.999999, (v / (m * (1 - m)) - e) / (1 - e))) - 1 else 1e6 end as s
  from (select avg(failed / docs) as m, var_pop(failed / docs) as v, avg(1.0 / docs) as e from hosts)
), rates as (
  select source, docs, s, round((failed + m * s) / (docs + s), 9) as host_rate from hosts, prior
), verdicts as (
  select source, host_rate, case when host_rate - 1.645 * sqrt(host_rate * (1 - host_rate) / (docs + s + 1)) > 0.125
    then 'block' else 'allow' end as host_verdict from rates
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (host_verdict = 'block' and content_failures > 0) as kept, rule_failures,
       content_failures, host_rate, host_verdict
from ruled join verdicts on ruled.source is not distinct from verdicts.source
"""
