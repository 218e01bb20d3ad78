"""Secret scans with multipart credential linking.

Plain patterns report what is a secret by itself. Parts that are only suspicious (a key-like string, an endpoint,
an access identifier that is too short) are reported when parts that complete them stand within one scope of the same
document. Everything is built-in Spark expressions: patterns run over whole texts, and only the few parts they
find are exploded, placed and linked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import stored, text_of


@dataclass(frozen=True)
class Part:
    """A pattern, the group whose length counts, and the role of the part in a credential."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    base: bool = False
    role: str = ""


#: The base patterns. A run of hex digits or of an access key is only taken in full, so asking for
#: the least length inside the pattern finds the same spans as dropping short ones afterwards.
BASE_PARTS = [
    Part("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1, True, "secret"),
    Part("access", r"AKIA[A-Z0-9]{16,}", 20, 0, True, "access"),
    Part("hex", r"[0-9a-f]{24,}", 24, 0, True, "secret"),
]
#: Parts that need others beside them.
WEAK_PARTS = [
    Part("keyid", r"""(?i:access_?key_?id|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.-]{6,}""", 6, 0, False, "access"),
    Part("keylike", r"[A-Za-z0-9+/_-]{32,}={0,2}", 32, 0, False, "secret"),
    Part("endpoint", r"(?i:https|jdbc:[a-z]+|redis|amqps?|postgres|mysql)://[A-Za-z0-9.-]+(?::[0-9]+)?", 10, 0, False, "endpoint"),
]
#: Code points between parts of one credential.
SCOPE = 160


def _found(text: Column, part: Part, number: int) -> Column:
    """Every match as ``(kind_no, i, gap, size, measured)``: the text before it since the last match, and its length."""
    matches = F.regexp_extract_all(text, F.lit(part.pattern), F.lit(0))
    gaps = F.slice(F.split(text, part.pattern, -1), F.lit(1), F.size(matches))
    measured = F.regexp_extract_all(text, F.lit(part.pattern), F.lit(part.group)) if part.group else matches
    one = lambda m, i: F.struct(
        F.lit(number).alias("kind_no"), i.alias("i"), F.length(F.get(gaps, i)).alias("gap"),
        F.length(m).alias("size"), F.length(F.get(measured, i)).alias("measured"),
    )
    return F.transform(matches, one)


def find_parts(documents: DataFrame, parts: list[Part]) -> DataFrame:
    """``doc_id, version, kind_no, start, end`` of every match; ``version`` tells texts of one id apart."""
    text = text_of()
    shape = "array<struct<kind_no:int,i:int,gap:int,size:int,measured:int>>"
    arrays = [F.when(F.regexp_like(text, F.lit(p.pattern)), _found(text, p, n).cast(shape)).otherwise(F.array().cast(shape)) for n, p in enumerate(parts)]
    rows = documents.select("doc_id", version_of(text).alias("version"), F.explode(F.flatten(F.array(*arrays))).alias("m"))
    flat = rows.select("doc_id", "version", "m.*").distinct()  # repeated rows of a document give the same parts
    before = Window.partitionBy("doc_id", "version", "kind_no").orderBy("i")
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    least = F.element_at(F.array(*[F.lit(p.least) for p in parts]), F.col("kind_no") + 1)
    return flat.select("doc_id", "version", "kind_no", end.alias("end"), (end - F.col("size")).alias("start"), (F.col("measured") >= least).alias("holds")).where("holds").drop("holds")


def version_of(text: Column) -> Column:
    return F.xxhash64(text)


def link_parts(found: DataFrame, parts: list[Part], scope: int = SCOPE) -> DataFrame:
    """Base parts, and weak parts that a complementary part stands near: an interval join by nearest neighbours.

    A weak part is reported if, within ``scope`` code points between them, there is a part of another role, one of
    the two roles is the secret, and they don't overlap. Starts and ends go in one order of position: before a start, the
    last end of a role is the nearest part that doesn't overlap, and after an end the first start. So one pass does,
    and no pairs are made. A weak part that overlaps a base part is left out.
    """
    name = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("kind_no") + 1)
    rows = found.withColumn("role", name([p.role for p in parts])).withColumn("base", name([p.base for p in parts]))
    # At one position ends come first: a part that ends where another starts doesn't overlap it.
    begins = F.col("begins")
    rows = rows.withColumn("begins", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("at", F.when(begins, F.col("start")).otherwise(F.col("end")))
    here = Window.partitionBy("doc_id", "version").orderBy("at", "begins", "kind_no")
    back, ahead = here.rowsBetween(Window.unboundedPreceding, -1), here.rowsBetween(1, Window.unboundedFollowing)
    near = {}
    for role in ("access", "secret", "endpoint"):
        mine = F.col("role") == role
        gap = F.when(begins, F.col("at") - F.max(F.when(mine & ~begins, F.col("at"))).over(back)).otherwise(
            F.min(F.when(mine & begins, F.col("at"))).over(ahead) - F.col("at")
        )
        near[role] = F.coalesce(gap <= scope, F.lit(False))
    complete = (
        F.when(F.col("role") == "secret", near["access"] | near["endpoint"]).otherwise(near["secret"])
    )
    based = F.col("base")
    covered = begins & (
        F.coalesce(F.max(F.when(based & begins, F.col("end"))).over(back) > F.col("start"), F.lit(False))
        | F.coalesce(F.min(F.when(based & begins, F.col("start"))).over(ahead) < F.col("end"), F.lit(False))
    )
    marked = rows.select("*", complete.alias("complete"), covered.alias("covered")).groupBy("doc_id", "version", "kind_no", "base", "start", "end")
    marked = marked.agg((based | (F.bool_or("complete") & ~F.bool_or("covered"))).alias("reported"))
    return marked.where("reported").select("doc_id", "version", "kind_no", name([p.kind for p in parts]).alias("kind"), "base", "start", "end")


def scan_secrets(documents: DataFrame, parts: list[Part] | None = None, scope: int = SCOPE) -> DataFrame:
    """``doc_id, version, spans``: the reported spans ``(start, kind_no, end, kind, base)`` of documents that have any."""
    parts = parts or BASE_PARTS + WEAK_PARTS
    one = F.struct("start", "kind_no", "end", "kind", "base")
    return link_parts(find_parts(documents, parts), parts, scope).groupBy("doc_id", "version").agg(F.array_sort(F.collect_list(one)).alias("spans"))


def documents_with_spans(documents: DataFrame, parts: list[Part] | None = None, scope: int = SCOPE) -> DataFrame:
    """Every document with its ``spans`` (empty if none), as ``doc_id, version, spans``.

    Null text counts as empty, a null id is an id like any other, repeated rows all return with the same spans.
    Other columns are ignored; no rows give no rows.
    """
    spans = scan_secrets(documents, parts, scope)
    keys = documents.select("doc_id", version_of(text_of()).alias("version"))
    joined = keys.alias("k").join(spans.alias("s"), F.expr("k.doc_id <=> s.doc_id and k.version = s.version"), "left")
    return joined.select("k.doc_id", "k.version", F.coalesce("s.spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))


def mask_secrets(documents: DataFrame, mask: str = "[secret]", parts: list[Part] | None = None, scope: int = SCOPE) -> DataFrame:
    """The documents with every reported span replaced by ``mask``; ``n_chars`` follows the text where it changes.

    Overlapping spans are replaced together. Texts without a span, null ones too, stay as they are. All columns
    stay, whatever their names.
    """
    found = scan_secrets(documents, parts, scope)
    # Overlapping spans become one: a span begins a new one if nothing before it reaches its start.
    spans = found.select("doc_id", "version", F.explode("spans").alias("s")).select("doc_id", "version", "s.start", "s.end")
    before = Window.partitionBy("doc_id", "version").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(before)
    opened = spans.withColumn("new", (reach.isNull() | (reach < F.col("start"))).cast("int"))
    so_far = Window.partitionBy("doc_id", "version").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    merged = opened.withColumn("no", F.sum("new").over(so_far)).groupBy("doc_id", "version", "no").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = merged.groupBy("doc_id", "version").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_mask_cuts"))
    cuts = stored(cuts.toDF("_mask_id", "_mask_version", "_mask_cuts"), "secret-cuts")
    names = [f"_mask_{i}" for i in range(len(documents.columns))]
    place = {name: names[i] for i, name in reversed(list(enumerate(documents.columns)))}
    own = documents.toDF(*names)
    text, doc_id = F.col(place["text"]), F.col(place["doc_id"])
    joined = own.join(cuts, doc_id.eqNullSafe(F.col("_mask_id")) & (version_of(F.coalesce(text, F.lit(""))) == F.col("_mask_version")), "left")
    cut = F.col("_mask_cuts")
    kept = F.transform(
        F.sequence(F.lit(0), F.size(cut)),
        lambda i: F.substring(
            text,
            (F.coalesce(F.get(cut, i - 1)["end"], F.lit(0)) + 1).cast("int"),
            (F.coalesce(F.get(cut, i)["start"], F.length(text)) - F.coalesce(F.get(cut, i - 1)["end"], F.lit(0))).cast("int"),
        ),
    )
    clean = F.when(cut.isNull(), text).otherwise(F.array_join(kept, mask))
    changed = {place["text"]: clean}
    if "n_chars" in place:
        kind = documents.schema["n_chars"].dataType
        changed[place["n_chars"]] = F.when(cut.isNull(), F.col(place["n_chars"])).otherwise(F.length(clean).cast(kind))
    return joined.select(*[changed.get(names[i], F.col(names[i])).alias(name) for i, name in enumerate(documents.columns)])
