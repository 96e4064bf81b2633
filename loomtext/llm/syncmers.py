"""Document fingerprints of closed syncmers (native).

A text's tokens are its words; a word of more than 24 characters (a script without spaces, an encoded run) gives its
characters instead. A k-mer of tokens is an anchor if the least of its inner s-mers, by hash, is its first or its last:
a property of the k-mer alone, so what stands around a passage doesn't change which of its k-mers are chosen, and any
k - s consecutive k-mers without one are ruled out. The fingerprint is the sequence of the anchors' 32-bit hashes, in
order of position, 8 hexadecimal digits each.

Likeness is positional. The n-th occurrence of an anchor in one fingerprint meets its n-th occurrence in the other; matches
that follow each other without a gap in both are one run; the heaviest chain of runs that ascend in both counts.
Likeness is twice the matches of that chain over the anchors of both (0 to 1): an anchor that is repeated more often, or
a passage that has moved past another, doesn't count. A text without an anchor (fewer than k tokens, or an unlucky few) has the
hash of all its tokens as its only one; a text without tokens has none, and two such texts have likeness 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, range_bounds, range_bucket

#: A whole word of at most 24 characters, or one character of a longer one.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,24}(?![^\x20\x09-\x0D])|[^\x20\x09-\x0D]"


def anchors(text: Column, k: int = 6, s: int = 2) -> Column:
    """array<int> of the text's closed syncmers, in order."""
    last = k - s  # place of a k-mer's last inner s-mer

    def digest(values: list[Column]) -> Column:
        return F.shiftright(F.xxhash64(*values), 32).cast("int")

    def chosen(inner: Column) -> Column:
        def mark(first: Column, i: Column) -> Column:
            at = lambda j: F.get(inner, i + j) if j else first
            least = lambda places: F.least(*[at(j) for j in places]) if len(places) > 1 else at(places[0])
            edge = (first <= least(range(1, last + 1))) | (at(last) <= least(range(last)))
            whole = [at(j) for j in [*range(0, last, s), last]]  # they cover the k-mer's tokens
            return F.when(at(last).isNotNull() & edge, digest(whole))

        return F.filter(F.transform(inner, mark), lambda x: x.isNotNull())

    def of_tokens(tokens: Column) -> Column:
        pairs = F.transform(tokens, lambda x, i: F.xxhash64(x, *[F.get(tokens, i + j) for j in range(1, s)]))
        inner = F.slice(pairs, F.lit(1), F.size(tokens) - (s - 1))
        none = F.array().cast("array<int>")
        found = F.when(F.size(tokens) >= k, let(inner, chosen)).otherwise(none)
        whole = F.when(F.size(tokens) > 0, F.array(digest([tokens]))).otherwise(none)
        return let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(whole))

    hashed = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))
    return let(hashed, of_tokens)


def written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def numbered(found: Column) -> Column:
    """array<bigint>: each anchor with the number of its occurrence, so that no two are equal. First occurrences stay
    themselves."""

    def groups(s: Column) -> Column:  # s: (anchor, place), sorted
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda j: (j == 0) | (F.get(s, j - 1)["x"] != F.get(s, j)["x"]))

        def group(st: Column, first: Column, g: Column) -> Column:
            key = lambda j: F.when(j == first, F.get(s, j)["x"].cast("long")).otherwise(F.xxhash64(F.get(s, j)["x"], j - first))
            return F.transform(F.sequence(first, F.coalesce(F.get(st, g + 1), n) - 1), lambda j: F.struct(F.get(s, j)["i"].alias("i"), key(j).alias("k")))

        spread = let(starts, lambda st: F.flatten(F.transform(st, lambda first, g: group(st, first, g))))
        return F.transform(F.array_sort(spread), lambda e: e["k"])

    plain = F.transform(found, lambda x: x.cast("long"))
    placed = F.array_sort(F.transform(found, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(found)) == F.size(found), plain).otherwise(let(placed, groups))


def chained(a: Column, b: Column) -> Column:
    """Matches of the heaviest chain of runs, of two arrays without repeats."""
    side = lambda keys, n: F.transform(keys, lambda k, i: F.struct(k.alias("k"), F.lit(n).alias("side"), i.alias("i")))

    def met(s: Column) -> Column:  # both sides' keys, sorted: equal ones are neighbours
        pairs = F.transform(s, lambda e, j: F.when(F.get(s, j + 1)["k"] == e["k"], F.struct(e["i"].alias("p"), F.get(s, j + 1)["i"].alias("q"))))
        return F.array_sort(F.filter(pairs, lambda x: x.isNotNull()))

    def runs(m: Column) -> Column:
        def breaks(j: Column) -> Column:
            before, now = F.get(m, j - 1), F.get(m, j)
            return (j == 0) | (now["p"] != before["p"] + 1) | (now["q"] != before["q"] + 1)

        starts = F.filter(F.sequence(F.lit(0), F.size(m) - 1), breaks)
        run = lambda st, j, g: let(
            F.coalesce(F.get(st, g + 1), F.size(m)), lambda end: F.struct(F.get(m, j)["q"].alias("first"), F.get(m, end - 1)["q"].alias("last"), (end - j).alias("n"))
        )
        return let(starts, lambda st: F.transform(st, lambda j, g: run(st, j, g)))

    def chain(r: Column) -> Column:
        # of the chains so far only those stay that no other beats, one that ends no later and is no lighter
        def add(done: Column, x: Column) -> Column:
            best = F.array_max(F.transform(F.filter(done, lambda d: d["last"] < x["first"]), lambda d: d["n"]))
            new = F.struct(x["last"].alias("last"), (x["n"] + F.coalesce(best, F.lit(0))).alias("n"))

            def put(e: Column) -> Column:
                beaten = F.exists(done, lambda d: (d["last"] <= e["last"]) & (d["n"] >= e["n"]))
                rest = F.filter(done, lambda d: (d["last"] < e["last"]) | (d["n"] > e["n"]))
                return F.when(beaten, done).otherwise(F.concat(rest, F.array(e)))

            return let(new, put)

        none = F.array().cast("array<struct<last:int,n:int>>")
        whole = F.aggregate(r, none, add, lambda done: F.array_max(F.transform(done, lambda d: d["n"])))
        return F.when(F.size(r) == 1, F.get(r, F.lit(0))["n"]).otherwise(whole)

    sorted_ = F.array_sort(F.concat(side(a, 0), side(b, 1)))
    matched = let(let(let(sorted_, met), runs), chain)
    return F.when(a == b, F.size(a)).when(F.arrays_overlap(a, b), matched).otherwise(F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Of two arrays of numbered anchors."""
    all_ = F.size(a) + F.size(b)
    return F.when(all_ == 0, F.lit(1.0)).otherwise(2 * chained(a, b) / all_)


def with_next(docs: DataFrame, columns: list[str], key: str, ranges: int) -> DataFrame:
    """docs with next: the struct of the given columns of the row of the next key (after the last: of the first), in
    one exchange. Rows are dealt by ranges of the key; the first row of each range also goes, as a guest, to the range
    before it, and the first of all to the last range."""
    bounds = range_bounds(docs.where(F.col(key).isNotNull()), key, ranges)
    ranged = docs.withColumn("__range", range_bucket(key, bounds).cast("int"))
    heads = ranged.groupBy("__range").agg(F.min(key).alias("head"), F.max(F.col(key).isNull()).alias("nulls")).orderBy("__range").collect()
    if not heads:
        kind = docs.select(F.struct(*columns).alias("next")).schema["next"].dataType
        return docs.withColumn("next", F.lit(None).cast(kind))
    numbers = [h["__range"] for h in heads]
    first, size = numbers[0], numbers[-1] + 1
    head, before = [None] * size, [None] * size
    for i, h in enumerate(heads):
        head[h["__range"]] = None if h["nulls"] else h["head"]
        before[h["__range"]] = numbers[i - 1]
    lookup = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("__range"))
    kind = docs.schema[key].dataType.simpleString()
    own = F.struct(F.col("__range").alias("r"), F.lit(0).alias("late"))
    guest = F.struct(lookup(before, "int").alias("r"), F.when(F.col("__range") == first, 2).otherwise(1).alias("late"))
    places = F.when(F.col(key).eqNullSafe(lookup(head, kind)), F.array(own, guest)).otherwise(F.array(own))
    dealt = ranged.withColumn("__to", F.explode(places)).select(*docs.columns, F.col("__to.r").alias("__r"), F.col("__to.late").alias("__late"))
    texts = [c for c in columns if c != key and docs.schema[c].dataType.simpleString() == "string"]
    order = Window.partitionBy("__r").orderBy("__late", F.asc_nulls_first(key), *texts)
    for c in columns:
        dealt = dealt.withColumn(f"__next_{c}", F.lead(c).over(order))
    met = F.struct(*[F.col(f"__next_{c}").alias(c) for c in columns])
    return dealt.where("__late = 0").select(*docs.columns, met.alias("next"))


def fingerprint(docs: DataFrame, k: int = 6, s: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, anchors and fingerprint, one row per input row. Null texts count as empty; null ids and repeated
    rows are kept; equal texts have equal fingerprints; an empty table gives an empty result; other columns are not read."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marked = named.withColumn("anchors", anchors(F.col("text"), k, s))
    return marked.withColumn("fingerprint", written(F.col("anchors")))


def op4_closed_syncmers(spark, sf_dir: str) -> DataFrame:
    docs = fingerprint(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("fingerprint")
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = with_next(docs, ["text", "anchors"], "doc_id", ranges)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    there = F.col("next.text")
    take = F.least(half, F.length(there))
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(there, F.lit(1), take))
    changed = met.select("doc_id", n.cast("long").alias("n_chars"), "anchors", F.col("next.anchors").alias("after"), edited.alias("edited"))
    changed = changed.withColumn("edited_anchors", anchors(F.col("edited")))
    changed = changed.withColumns({f"__{c}": numbered(F.col(c)) for c in ("anchors", "after", "edited_anchors")})
    return changed.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("anchors")).alias("fingerprint"), written(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("__anchors"), F.col("__edited_anchors")).alias("near_edited"),
        likeness(F.col("__anchors"), F.col("__after")).alias("near_next"),
    )
