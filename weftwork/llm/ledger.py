"""Secrets in every version of every document, by a ledger of contents that were scanned before.

A text is known by its content address, its SHA-256. The ledger is a table of (blob, rule, version of the rule) pairs
with the findings of each; a pair that stands in it is never scanned again. A run addresses all versions it is given,
subtracts the pairs of the ledger, scans one copy of each blob that is left with the rules it still lacks, appends the
findings, and joins the ledger back to all paths. So copies, files that were moved, and versions that only come back cost
nothing, and a changed rule scans each blob once more for that rule alone.

All of it is DataFrame functions. Positions come from lengths: a text split at the matches of a pattern, and the matches
themselves, alternate, so a running sum of both gives every start and end in code points.

Hot blobs: a copy is chosen by an aggregate with a partial step before the shuffle, and the join back to the paths lets
adaptive execution split a hot address.

Defined results: a null text is the empty text; repeated rows each get their findings; a null path is kept; columns
beyond the named ones stay out of the way and are returned only when named as ``paths``.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.llm.common import written
from weftwork.operators.joins import adaptive_join, sized_join


@dataclass(frozen=True)
class Rule:
    """A pattern; of its matches those count whose ``group`` (0: the whole match) has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


#: The patterns, written with every letter in both cases where either may stand.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),  # shorter runs need no look: a run is matched whole or not at all
)

_LEDGER = "blob string, kind string, version int, spans array<struct<start:bigint,stop:bigint>>"


def _cuts(text: Column, hits: Column, rule: Rule) -> Column:
    """For each hit the characters before it since the last hit, its own, and those of the part that must be long enough."""
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    sizes = F.transform(hits, F.length)
    parts = F.transform(hits, lambda hit: F.length(F.regexp_extract(hit, rule.pattern, rule.group))) if rule.group else sizes
    return F.transform(
        F.slice(F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), parts.alias("part")), 1, F.size(hits)),
        lambda cut: F.struct(cut["gap"].cast("long").alias("gap"), cut["size"].cast("long").alias("size"), cut["part"].alias("part")),
    )


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of the blobs ``(blob, text, lacking)``: one row for each pair, in the columns of the ledger."""
    hits = [F.when(F.array_contains("lacking", k), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))).alias(f"hits_{k}") for k, rule in enumerate(rules)]
    found = blobs.select("blob", "text", *hits)
    none = F.array().cast("array<struct<gap:bigint,size:bigint,part:int>>")
    pairs = F.array(
        *(
            F.struct(
                F.lit(rule.kind).alias("kind"),
                F.lit(rule.version).alias("version"),
                F.lit(rule.least).alias("least"),
                F.when(F.size(f"hits_{k}") > 0, _cuts(F.col("text"), F.col(f"hits_{k}"), rule)).when(F.col(f"hits_{k}").isNotNull(), none).alias("cuts"),
            )
            for k, rule in enumerate(rules)
        )
    )
    scanned = written(found.select("blob", F.explode(pairs).alias("pair")).select("blob", "pair.*").filter("cuts is not null"), "scanned")
    place = Window.partitionBy("blob", "kind", "version").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = scanned.filter("size(cuts) > 0").select("blob", "kind", "version", "least", F.posexplode("cuts").alias("pos", "cut"))
    hit = hit.withColumn("stop", F.sum(F.col("cut.gap") + F.col("cut.size")).over(place))
    span = F.when(F.col("cut.part") >= F.col("least"), F.struct((F.col("stop") - F.col("cut.size")).alias("start"), "stop"))
    spans = hit.groupBy("blob", "kind", "version").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    clean = scanned.filter("size(cuts) = 0").select("blob", "kind", "version", F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))
    return clean.unionByName(spans)


def addressed(versions: DataFrame, text: str = "text") -> DataFrame:
    """The versions with the content address of their text in a column ``blob``; a null text counts as empty."""
    return versions.withColumn(text, F.coalesce(text, F.lit(""))).withColumn("blob", F.sha2(text, 256))


def read_ledger(spark, path: str) -> DataFrame:
    """The pairs of a ledger, each once, also where two runs at the same time have scanned the same one."""
    spark.createDataFrame([], _LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(_LEDGER).parquet(path).dropDuplicates(["blob", "kind", "version"])


def scan_unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Append to the ledger what the rules find in blobs that they have not seen yet."""
    spark = versions.sparkSession
    texts = addressed(versions.select(F.col(text).alias("text")))
    wanted = F.array(*(F.lit(k) for k in range(len(rules))))
    number = F.create_map(*(x for k, rule in enumerate(rules) for x in (F.lit(f"{rule.kind}/{rule.version}"), F.lit(k))))
    known = read_ledger(spark, ledger).withColumn("rule", number[F.concat_ws("/", "kind", "version")]).filter("rule is not null")
    if known.isEmpty():
        lacking = None
    else:
        seen = known.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        blobs = adaptive_join(texts.select("blob").distinct(), seen, ["blob"], "left")
        left = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<int>")))
        lacking = written(blobs.select("blob", left.alias("lacking")).filter("size(lacking) > 0"), "unseen")
        texts = sized_join(texts, lacking.select("blob"), ["blob"], "left_semi")
    once = texts.groupBy("blob").agg(F.first("text").alias("text"))
    once = once.withColumn("lacking", wanted) if lacking is None else adaptive_join(once, lacking, ["blob"])
    _scan(once, rules).write.mode("append").option("compression", "zstd").parquet(ledger)


def findings(versions: DataFrame, ledger: str, paths: list[str], rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """For every row of ``versions`` its ``paths`` columns, ``blob`` and ``spans (start, stop, kind)``, in order of start, then rule.

    The ledger is brought up to date first. ``start`` and ``stop`` (exclusive) count code points.
    """
    scan_unseen(versions, ledger, rules, text)
    number = F.create_map(*(x for k, rule in enumerate(rules) for x in (F.lit(f"{rule.kind}/{rule.version}"), F.lit(k))))
    pairs = read_ledger(versions.sparkSession, ledger).withColumn("rule", number[F.concat_ws("/", "kind", "version")])
    hits = pairs.filter("rule is not null and size(spans) > 0").select(
        "blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("rule").alias("rule"), s["stop"].alias("stop"), F.col("kind").alias("kind"))).alias("spans")
    )
    hits = hits.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    rows = addressed(versions.select(F.col(text).alias("text"), F.struct(*paths).alias("path"))).drop("text")
    joined = adaptive_join(rows, hits, ["blob"], "left")
    none = F.array().cast(hits.schema["spans"].dataType)
    return joined.select("path.*", "blob", F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:stop`` for each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
