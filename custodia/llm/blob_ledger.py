"""Secret scans: an incremental ledger of content-addressed blobs.

Every version of a text is a blob, named by the SHA-256 of its bytes. The ledger holds the pairs of
blob and rule version that were scanned, with what was found. A scan looks only at pairs that the
ledger lacks, one text for each blob, and findings are joined back to all rows that hold the blob.

Nulls, empties, ties: a null text is an empty one, whose blob has no findings. Rows that share a
blob, and repeated rows, all get its findings; null ids are ids like any other for that. Other
columns are passed on. Without documents the result is empty and the ledger gets no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import dropped_at_end, new_place, small_batches

#: The base rules (pattern, group that counts, least length), in their order.
BASE_RULES = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
#: Public key and token formats, added to the base rules.
MORE_RULES = {
    "private_key": (r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    "web_token": (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    "host_token": (r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    "chat_token": (r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    "url_login": (r"[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s:/@]+@", 0, 10),
}
#: A text that holds none of these (in lower case) has no match of the rule.
NEEDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",), "private_key": ("private key",),
    "web_token": ("eyj",), "host_token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "chat_token": ("xox",), "url_login": ("://",),
}
RULES = BASE_RULES | MORE_RULES


def version(name: str) -> str:
    """Changes with the rule itself, so that a changed rule scans old blobs anew."""
    return hashlib.sha256(repr(RULES[name]).encode()).hexdigest()[:16]


def spans(text: str, names: list[str]) -> list[tuple[int, int, int]]:
    """(start, end, place of the rule in names) of all matches, leftmost and not overlapping per rule."""
    low, out = text.lower(), []
    for k, name in enumerate(names):
        pattern, group, least = RULES[name]
        if name == "hex":  # the same matches, but short ones are passed over without a match object
            pattern = r"[0-9a-f]{16,}"
        elif name in NEEDS and not any(x in low for x in NEEDS[name]):
            continue
        for m in re.finditer(pattern, text, re.ASCII):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


FINDINGS = "array<struct<start:long,end:long,kind:string>>"


def scanned(text: Column, names: list[str]) -> Column:
    @F.arrow_udf(FINDINGS)
    def scan(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        found = ([{"start": a, "end": b, "kind": names[k]} for a, b, k in spans(x.as_py(), names)] for x in texts)
        return pa.array(list(found), kind)

    return scan(text)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def unseen(docs: DataFrame, ledger: DataFrame | None, versions: dict[str, str]) -> DataFrame:
    """(blob, text, rules): one text for each blob that some rule version has not scanned.

    Texts travel only for the rows that are scanned: the choice is made on ids and digests.
    """
    mark = F.xxhash64(F.lit(1), "__id")  # which of the rows of a blob stands for it
    paths = docs.select(blob_of(F.col("text")).alias("blob"), F.col("doc_id").alias("__id"))
    each = paths.groupBy("blob").agg(F.min_by("__id", F.struct(mark, "__id")).alias("__id"), F.count_if(F.col("__id").isNull()).alias("__none"))
    wanted = F.array([F.struct(F.lit(k).alias("rule"), F.lit(v).alias("version")) for k, v in versions.items()])
    if ledger is not None:
        seen = ledger.select("blob", F.struct("rule", "version").alias("__s")).groupBy("blob").agg(F.collect_set("__s").alias("__seen"))
        each = each.join(seen, "blob", "left").withColumn("rules", F.array_except(wanted, F.coalesce("__seen", F.array().cast(seen.schema["__seen"].dataType))))
        each = each.where(F.size("rules") > 0)
    else:
        each = each.withColumn("rules", wanted)
    rows = docs.select(blob_of(F.col("text")).alias("blob"), F.col("doc_id").alias("__id"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = each.select("blob", "__id", "rules")
    # An id may stand for several blobs, a blob's id may be null or repeated; then one text is taken.
    hit = rows.join(chosen, (rows["__id"].eqNullSafe(chosen["__id"])) & (rows["blob"] == chosen["blob"]), "inner")
    return hit.select(rows["blob"], "text", "rules")


def scan(docs: DataFrame, ledger: str | None = None, names: list[str] | None = None) -> DataFrame:
    """docs with blob and findings (all spans by start, then by the order of the rules).

    ledger: a Parquet folder of (blob, rule, version, findings) that the scan reads and appends to;
    without one, a new ledger is kept in the shared folder until the application ends.
    """
    names = list(names or RULES)
    versions = {k: version(k) for k in names}
    spark, old = docs.sparkSession, None
    small_batches(spark)
    kind = f"blob string, rule string, version string, findings {FINDINGS}"
    kept = ledger is not None
    if not kept:
        ledger = new_place(spark, "ledger")
    else:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
        if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            old = spark.read.schema(kind).parquet(ledger)
    new = unseen(docs, old, versions)
    one = new.select("blob", "rules", scanned(F.col("text"), names).alias("__f"))
    # Rows that repeat an id and a text are one blob; hashing made them equal, so any of them will do.
    one = one.groupBy("blob").agg(F.any_value("rules").alias("rules"), F.any_value("__f").alias("__f"))
    wide = one.select(
        "blob", F.explode("rules").alias("__r"), "__f"
    ).select("blob", "__r.rule", "__r.version", F.filter("__f", lambda x: x["kind"] == F.col("__r.rule")).alias("findings"))
    wide.write.mode("append").parquet(ledger)
    if not kept:
        dropped_at_end(spark, ledger)
    whole = spark.read.schema(kind).parquet(ledger)
    current = F.array([F.struct(F.lit(k).alias("rule"), F.lit(v).alias("version")) for k, v in versions.items()])
    found = (
        whole.where(F.size("findings") > 0).where(F.array_contains(current, F.struct("rule", "version")))
        .groupBy("blob", "rule", "version").agg(F.any_value("findings").alias("findings"))
        .groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings"))
    )
    order = F.create_map([F.lit(x) for k, name in enumerate(names) for x in (name, k)])
    by = F.transform("findings", lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("place"), x["end"].alias("end"), x["kind"].alias("kind")))
    found = found.select("blob", F.transform(F.array_sort(by), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))).alias("findings"))
    return joined_back(docs, found)


def joined_back(docs: DataFrame, found: DataFrame, salts: int = 16) -> DataFrame:
    """Findings on all rows of their blobs; a blob with many rows is spread over salts."""
    left = docs.withColumns({"__blob": blob_of(F.col("text"))})
    keys = [x for x in ("doc_id",) if x in docs.columns]
    left = left.withColumn("__salt", F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int"))
    right = found.select(F.col("blob").alias("__blob"), "findings", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"))
    out = left.join(right, ["__blob", "__salt"], "left")
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("blob", "findings")]
    none = F.array().cast(FINDINGS)
    return out.select(*own, F.col("__blob").alias("blob"), F.coalesce("findings", none).alias("findings"))


def joined(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and all spans."""
    out = scan(docs.select("doc_id", "text"), ledger)
    base = F.filter("findings", lambda x: x["kind"].isin(list(BASE_RULES)))
    count = lambda k: F.size(F.filter("findings", lambda x: x["kind"] == k)).cast("long")
    return out.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_RULES],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"), "blob",
    )


def redacted(docs: DataFrame, ledger: str | None = None, mark: str = "[secret]") -> DataFrame:
    """docs with every finding replaced by a mark, and n_chars, where there is one, of the new text."""
    out = scan(docs, ledger).select(*[F.col(f"`{c}`") for c in docs.columns], F.col("findings").alias("__findings"))

    @F.arrow_udf("string")
    def clean(texts: pa.Array, findings: pa.Array) -> pa.Array:
        made = []
        for t, f in zip(texts.to_pylist(), findings.to_pylist(), strict=True):
            at, kept = 0, []
            for x in f or ():
                if x["end"] > at:
                    kept += [t[at : x["start"]], mark] if x["start"] >= at else []
                    at = x["end"]
            made.append(t if not f else "".join(kept) + t[at:])
        return pa.array(made, pa.string())

    hit = F.size("__findings") > 0
    out = out.withColumn("__text", F.when(hit, clean(F.when(hit, F.col("text")), F.when(hit, F.col("__findings")))).otherwise(F.col("text")))
    changed = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(hit, F.length("__text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
