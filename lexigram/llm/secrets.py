"""Secret scans with an incremental blob ledger, in built-in DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger is a table folder of scanned
``(blob, rules)`` with the findings, added to run by run: a scan looks only at pairs of blob and rule version that the ledger
lacks, once per blob however many paths and versions hold it, and joins the findings back to all of them. A rule whose pattern
changes gets a new version and is scanned again; findings of old versions stay in the ledger but are not reported.

Spans are code points, end exclusive, of the leftmost non-overlapping matches of a rule's pattern whose checked group is long
enough; shorter matches use up their text too. Positions come from the pieces between matches (``split``) and the matches
themselves (``regexp_extract_all``), both of which find the same ones.

Null texts are empty blobs without findings. Paths may repeat, be null, and hold any number of versions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigram.session import broadcast_if_small, scratch_dir, stored

SPANS = "array<struct<start:bigint,kind:string,end:bigint,rank:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern (Java syntax); ``checked`` is the group that must have at least ``least`` characters."""

    kind: str
    pattern: str
    checked: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Spans of the registered query's base kinds; fixed patterns.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        checked=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)

#: Lines of a key whose END line is missing: armour headers, base64 runs (behind quote marks, blanks or written-out line ends),
#: a short last line with padding, a checksum or at the end of the text.
_KEY_LINES = (
    r"""(?:(?:\\[nr]|[\s>|"',+#*])*+(?:(?:Version|Comment|Hash|Charset|MessageID|Proc-Type|DEK-Info):[^\r\n]*+"""
    r"""|[A-Za-z0-9+/]{16,}+={0,2}+(?=[\s\\"',]|\z)|[A-Za-z0-9+/]+={1,2}+(?=[\s\\"',]|\z)|=[A-Za-z0-9+/]{4}(?=[\s\\"',]|\z)"""
    r"""|(?<=[A-Za-z0-9+/][\r\n])[A-Za-z0-9+/]++\z))*+"""
)

#: Further kinds: public token formats. A key runs to its END line if no other BEGIN or END line comes first.
MORE = (
    Rule(
        "private_key",
        r"-----BEGIN ((?:[A-Z0-9]+ ){0,4}PRIVATE KEY(?: BLOCK)?)-----"
        r"(?:(?:(?!-----(?:BEGIN|END) )[\s\S])*+-----END \1-----|" + _KEY_LINES + ")",
        version=2,
    ),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{36,}", version=2),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]*+:[^\s/@]{3,}+@", version=2),
)

RULES = BASE + MORE


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """All spans of one rule in a text."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), lambda s: F.length(s).cast("bigint"))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda s: F.length(s).cast("bigint"))
    checked = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.checked)), lambda s: F.length(s).cast("bigint"))
    parts = F.arrays_zip(between.alias("gap"), whole.alias("size"), checked.alias("checked"))
    none = F.array().cast(SPANS)

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + part["size"]
        span = F.struct(start.alias("start"), F.lit(rule.kind).alias("kind"), end.alias("end"), F.lit(rank).alias("rank"))
        found = F.when(part["checked"] >= rule.least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(F.coalesce(end, state["at"]).alias("at"), found.alias("found"))

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found"))
    listed = F.aggregate(parts, begin, step, lambda state: state["found"])
    return F.when(text.rlike(rule.pattern), listed).otherwise(none)


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` (path, text) to ``(path, blob, spans)`` per row; unseen pairs are scanned and added to ``ledger``.

    ``ledger``: a table folder that executors can reach; it need not exist yet.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    listed = versions.select("path", F.sha2(text, 256).alias("blob"), text.alias("text"))
    index = stored(listed.select("path", "blob"), "versions")
    schema = f"blob string, rules array<string>, spans {SPANS}"
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("blob", "string"), ("rules", "array<string>"), ("spans", SPANS))]
    spark.range(0).select(*empty).write.mode("append").parquet(ledger)
    seen = spark.read.schema(schema).parquet(ledger)
    done = seen.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))

    wanted = F.array(*[F.lit(r.key) for r in rules])
    holders = index.groupBy("blob").agg(F.min(F.struct(F.col("path").isNull().alias("no_path"), "path")).alias("h"))
    unseen = holders.join(done, "blob", "left").select(
        "blob", F.col("h.path").alias("path"), F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))).alias("rules")
    )
    unseen = stored(unseen.where(F.size("rules") > 0), "unseen").hint("shuffle_hash")
    same = listed["blob"].eqNullSafe(unseen["blob"]) & listed["path"].eqNullSafe(unseen["path"])
    texts = listed.join(unseen, same).select(unseen["blob"], "rules", "text")
    found = [
        F.when(F.array_contains("rules", r.key), spans(F.col("text"), r, k)).otherwise(F.array().cast(SPANS))
        for k, r in enumerate(rules)
    ]
    texts.select("blob", "rules", F.flatten(F.array(*found)).alias("spans")).write.mode("append").parquet(ledger)

    # a row may hold findings of old versions beside current ones
    own = lambda s: [(s["kind"] == r.kind) & F.array_contains("rules", r.key) for r in rules]
    current = F.filter("spans", lambda s: reduce(Column.__or__, own(s)))
    now = spark.read.schema(schema).parquet(ledger).where(F.arrays_overlap("rules", wanted) & (F.size("spans") > 0))
    rows = now.select("blob", F.explode(current).alias("s"))
    per_blob = rows.groupBy("blob").agg(F.sort_array(F.collect_set("s")).alias("spans"))
    return index.join(per_blob, "blob", "left").select("path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then rank of the kind."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["rank"].alias("b"), s["end"].alias("c"), s["kind"].alias("d")))
    )
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["d"], s["a"].cast("string"), s["c"].cast("string"))), ",")


def _count(rank: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("bigint")


def report(docs: DataFrame) -> DataFrame:
    """One row per document, over a ledger of its own."""
    found = scan(docs.select(F.col("doc_id").alias("path"), "text"), scratch_dir(docs.sparkSession, "ledger"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    counts = [_count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return found.select(
        F.col("path").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def masked(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with every span replaced by ``[kind]``; rows without a finding stay as they are."""
    ledger = ledger or scratch_dir(docs.sparkSession, "ledger")
    found = scan(docs.select(F.col("doc_id").alias("path"), "text"), ledger).where(F.size("spans") > 0)
    found = stored(found.select("blob", F.to_json("spans").alias("spans")).distinct(), "findings")
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        kept = F.when(
            s["start"] >= state["at"],
            F.concat(
                state["out"],
                F.col("text").substr((state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")),
                F.lit("["),
                s["kind"],
                F.lit("]"),
            ),
        ).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), kept.alias("out"))

    rest = F.length("text").cast("int")
    cut = F.aggregate(
        F.array_sort(F.from_json("spans", SPANS)),
        begin,
        step,
        lambda state: F.concat(state["out"], F.col("text").substr((state["at"] + 1).cast("int"), rest)),
    )
    own = docs.select(F.struct(*docs.columns).alias("doc"), "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))
    rows = own.join(broadcast_if_small(found), "blob", "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(cut).alias("text")
    return rows.select(*[text if c == "text" else F.col(f"doc.{c}") for c in docs.columns])
