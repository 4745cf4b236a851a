"""Secret scans with an incremental ledger of content-addressed blobs."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import map_texts, texts_of, written


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping, of which those that ``holds`` rejects are dropped.

    ``hints`` are lower-case strings of which a text has one if it can match at
    all; without hints every text is searched.
    """

    kind: str
    pattern: str
    holds: Callable[[re.Match], bool] = bool
    flags: int = 0
    hints: tuple[str, ...] = ()


def _long_value(found: re.Match) -> bool:
    return len(found[2]) >= 12


def _long_access(found: re.Match) -> bool:
    return len(found[0]) >= 18


#: In this order among spans that start together. ASCII: no letter outside A-Z counts as another case of one.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        _long_value,
        re.IGNORECASE | re.ASCII,
        ("passw", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", _long_access, 0, ("akia",)),
    # A run of 16 or more: shorter runs fail, and runs of one kind of character never overlap.
    Rule("hex", r"[0-9a-f]{16,}"),
)
RULES = (*BASE_RULES, Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key",)))

SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
)


def scanner(rules: tuple[Rule, ...]) -> Callable[[str], list[dict]]:
    compiled = [(re.compile(rule.pattern, rule.flags).finditer, rule) for rule in rules]

    def scan(text: str) -> list[dict]:
        lower = text.lower()
        spans = []
        for order, (search, rule) in enumerate(compiled):
            if not rule.hints or any(hint in lower for hint in rule.hints):
                spans += [(m.start(), order, m.end()) for m in search(text) if rule.holds(m)]
        return [{"kind": rules[order].kind, "start": start, "end": end} for start, order, end in sorted(spans)]

    return scan


def scan_history(
    history: DataFrame,
    rule_version: str,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    path_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Scan each distinct content once for each version of the rules.

    ``history`` has a row for each version of each path. ``ledger`` (blob,
    rule_version, findings) is what earlier runs have scanned; blobs that it has
    under this version are not scanned again. Returns the findings of all rows
    of ``history`` (doc_id, blob, findings: array of kind, start, end in code
    points, by start, then in the order of the rules) and the ledger's new rows.

    A blob is named by its SHA-256, which alone decides. Contents are made
    distinct by it within tasks before they are shuffled, so a blob that a third
    of all rows share arrives once from each task, and by it they meet the
    ledger where that shuffle put them. A NULL text is an empty blob; a repeated
    row repeats its result; NULL paths stay; other columns don't matter; an
    empty history gives no rows.
    """
    named = texts_of(history, path_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    named = named.withColumn("blob", F.unhex(F.sha2("text", 256)))
    blobs = named.select("blob", "text").dropDuplicates(["blob"])  # by the key of the join: one shuffle serves both
    if ledger is not None:
        ledger = ledger.filter(F.col("rule_version") == rule_version)
        blobs = blobs.join(ledger.select("blob"), "blob", "left_anti")
    schema = T.StructType([T.StructField("blob", T.BinaryType()), T.StructField("findings", SPANS)])

    def start():
        scan = scanner(rules)
        return lambda blobs, texts: (blobs, [scan(text) for text in texts])

    fresh = written(map_texts(blobs, start, schema, "text"))  # findings and ledger come from one scan
    scanned = fresh if ledger is None else fresh.unionByName(ledger.select("blob", "findings"))
    # Blobs without findings need no row: the join is with those few that have some.
    hits = scanned.filter(F.size("findings") > 0).withColumnRenamed("findings", "found")
    findings = (
        named.select("doc_id", "blob")
        .join(hits, "blob", "left")
        .select("doc_id", "blob", F.coalesce("found", F.array().cast(SPANS)).alias("findings"))
    )
    return findings, fresh.select("blob", F.lit(rule_version).alias("rule_version"), "findings")
