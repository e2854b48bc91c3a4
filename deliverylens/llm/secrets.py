"""Secret scan with an incremental blob ledger.

Every version of every text is addressed by its content. A ledger in shared storage
holds, for each blob, the rule versions that have read it and what they found. A scan
reads only blobs that some rule version has not seen, with just those rules, and joins
findings back to all rows that carry the blob. DataFrame functions throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deliverylens.llm.storage import fresh_folder, written


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    value_group: int = 0  # whose length counts
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules, in the order in which their kinds are listed.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        value_group=2,
        least=8,
    ),
    # a run of letters below the least length fails as a whole, so the count may stand in the pattern
    Rule("access", 1, "AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, "[0-9a-f]{32,}"),
)
# Published forms of keys that name their issuer.
MORE_RULES = (
    Rule("pem", 1, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("hosted", 1, "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", 1, "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = (
    "blob binary, rules array<string>,"
    " spans array<struct<start:bigint, place:int, kind:string, stop:bigint>>"
)


def blob_id(text: Column) -> Column:
    """The content address of a text, null as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _matches(text: Column, place: int, rule: Rule) -> Column:
    """One struct for each match of a rule: what lies between matches tells where they are."""
    between = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p).cast("long"))
    lengths = lambda group: F.transform(
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)), lambda m: F.length(m).cast("long")
    )
    zipped = F.arrays_zip(between.alias("before"), lengths(0).alias("size"), lengths(rule.value_group).alias("value"))
    return F.when(
        text.rlike(rule.pattern),
        F.transform(
            # the piece behind the last match has no match
            F.filter(zipped, lambda z: z["size"].isNotNull()),
            lambda z, i: F.struct(
                F.lit(place).alias("place"),
                F.lit(rule.kind).alias("kind"),
                i.alias("number"),
                z["before"].alias("before"),
                z["size"].alias("size"),
                (z["value"] >= rule.least).alias("holds"),
            ),
        ),
    )


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of blobs (blob, text, todo: names of the rules to run)."""
    none = F.expr(
        "cast(array() as array<struct<place:int,kind:string,number:int,before:bigint,size:bigint,holds:boolean>>)"
    )
    found = [
        F.when(F.array_contains("todo", rule.name), F.coalesce(_matches(F.col("text"), place, rule), none)).otherwise(
            none
        )
        for place, rule in enumerate(rules)
    ]
    # one row a match, or one without any; from here on no text is moved
    rows = (
        blobs.select("blob", "todo", F.explode_outer(F.concat(*found)).alias("m"))
        .select("blob", "todo", "m.*")
        .repartition("blob")
    )
    of_rule = Window.partitionBy("blob", "place").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("stop", F.sum(F.col("before") + F.col("size")).over(of_rule))
        .withColumn("start", F.col("stop") - F.col("size"))
        .withColumn("holds", F.coalesce("holds", F.lit(False)))
    )
    span = F.struct("start", "place", "kind", "stop")
    return (
        placed.select("blob", "todo", F.when(F.col("holds"), span).alias("span"))
        .groupBy("blob")
        .agg(F.first("todo").alias("rules"), F.sort_array(F.collect_list("span")).alias("spans"))
    )


def open_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger in a folder, one row a blob and run; a new folder starts an empty one."""
    empty = ", ".join(
        f"cast(null as {kind}) as {name}"
        for name, kind in (("blob", "binary"), ("rules", "array<string>"), ("spans", LEDGER.split(" spans ")[1]))
    )
    spark.sql(f"select {empty} where false").write.mode("ignore").parquet(folder)
    return spark.read.schema(LEDGER).parquet(folder)


def update_ledger(docs: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger has not seen of the texts of ``docs``, add it in one
    committed write, and return the ledger's findings: blob, spans (by start, then
    rule), for the given rule versions.

    Spans of rule versions that are no longer asked for stay in the ledger but are not
    returned. An attempt that fails leaves the ledger as it was.
    """
    spark = docs.sparkSession
    wanted = F.array(*(F.lit(r.name) for r in rules))
    # copies meet before texts are moved: both are keys, so each task sends one of a kind
    blobs = docs.select(blob_id(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    seen = open_ledger(spark, folder)
    if seen.isEmpty():
        unseen = blobs.withColumn("todo", wanted)
    else:
        read = seen.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))
        todo = F.array_except(wanted, F.coalesce("rules", F.expr("cast(array() as array<string>)")))
        unseen = blobs.join(read, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)
    scan_blobs(unseen, rules).write.mode("append").parquet(folder)
    asked = F.create_map(*(F.lit(x) for r in rules for x in (r.kind, r.name)))
    places = F.create_map(*(F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)))
    # of a kind, only what the asked version found; its place is that of today's list
    own = F.transform(
        F.filter("spans", lambda s: F.array_contains("rules", asked[s["kind"]])),
        lambda s: F.struct(s["start"], places[s["kind"]].alias("place"), s["kind"], s["stop"]),
    )
    rows = open_ledger(spark, folder).select("blob", own.alias("spans"))
    return rows.groupBy("blob").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def scan_secrets(docs: DataFrame, folder: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (start, place, kind, stop) for every row of ``docs``.

    Positions count code points from 0, ``stop`` is exclusive, ``place`` is that of
    the kind among the rules. Null and empty texts are one blob without spans.
    Repeated rows and null ids stay. Other columns are not read; an empty table gives
    an empty result. Without a folder the ledger is a new one.
    """
    folder = folder or fresh_folder(docs.sparkSession, "ledger")
    # only blobs with findings take part in the join; from a written table, so that its
    # size is known and a blob that many rows carry can be split
    found = written(update_ledger(docs, folder, rules).where(F.size("spans") > 0), "findings")
    carried = docs.select("doc_id", blob_id(F.col("text")).alias("blob"))
    return carried.join(found, "blob", "left").select(
        "doc_id", F.coalesce("spans", F.expr(f"cast(array() as {LEDGER.split(' spans ')[1]})")).alias("spans")
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, and all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["place"] < len(BASE_RULES))
    return found.select(
        "doc_id",
        *(of(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def covered_spans(found: DataFrame) -> DataFrame:
    """The spans of each blob with ``covered``, the furthest stop of those before."""
    before = Window.partitionBy("blob").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, -1)
    rows = found.select("blob", F.inline("spans")).withColumn(
        "covered", F.coalesce(F.max("stop").over(before), F.lit(0).cast("long"))
    )
    return rows.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "covered", "stop"))).alias("spans"))


def redact(docs: DataFrame, folder: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each secret's text replaced by [secret], spans that overlap by
    one; n_chars, where there is one, follows the new text. Rows without secrets, and
    all other columns, stay as they are."""
    folder = folder or fresh_folder(docs.sparkSession, "ledger")
    found = written(covered_spans(update_ledger(docs, folder, rules)), "findings").select(
        F.col("blob").alias("__blob"), F.col("spans").alias("__spans")
    )
    joined = docs.withColumn("__blob", blob_id(F.col("text"))).join(found, "__blob", "left")
    text, spans = F.col("text"), F.col("__spans")
    cut = lambda start, stop: F.when(
        stop > start, F.substring(text, (start + 1).cast("int"), (stop - start).cast("int"))
    ).otherwise("")
    pieces = F.transform(
        spans, lambda s: F.concat(cut(s["covered"], s["start"]), F.when(s["start"] >= s["covered"], "[secret]").otherwise(""))
    )
    last = F.array_max(F.transform(spans, lambda s: s["stop"]))
    masked = F.when(
        spans.isNotNull(), F.concat(F.array_join(pieces, ""), cut(last, F.length(text).cast("long")))
    ).otherwise(text)
    out = {c: F.col(f"`{c}`") for c in docs.columns}
    out["text"] = masked
    if "n_chars" in out:
        out["n_chars"] = F.when(spans.isNotNull(), F.length(masked).cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("n_chars")
        )
    return joined.select(*(c.alias(name) for name, c in out.items()))
