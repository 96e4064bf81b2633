"""Personal data: exact base patterns, and further identifiers by bootstrapped contextual extraction.

Seeds are the base spans (e-mail, IP address, card, phone) and strings that only a generator makes: 16 letters and digits or
more that change places at 45 of 100 places or more. Around a mention stand its lexical patterns: its key (`password=`, `token =`), or
else the two words left of it (^: none), the words left and right of it, and the two words right of it; a long value also has its
shape: alphabet, length and first letters. Other identifier-like tokens, and values behind a key, are candidates, each with its
patterns. Spark scores the bipartite graph of patterns and instances: a pattern's mass is the sum of the scores of its
instances, seeds at 1; against it stand the other distinct tokens in its context anywhere (and half a token), but for those that
may well be generated (16 letters and digits that change places twice): these say nothing until they are found. Confidence is
the mass's share of both. A pattern is good if its mass reaches `support` and its confidence `threshold`; an instance's score is the
best confidence of its good patterns, where a seed doesn't speak for itself. Scores start at the seeds and are passed
along until they settle, so an instance found with one pattern supports others. Seeds that are no base span, and
instances of good patterns, become spans of kind `id`; last, so do values of keys that a list names as secret (`ssn: ...`), which
take no part in the graph, for secrets that stand alone in a corpus.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialize

KINDS = ("email", "ip", "card", "phone", "id")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
LETTER = re.compile(r"[A-Za-z]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: A candidate: 8 characters or more of an identifier's alphabet, a digit and a letter among them, or 16 capitals and
#: digits. Bare numbers are left to the base patterns: one that fails their checks (Luhn, lengths) is not personal data
#: by its context alone.
VALUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_+/-]{6,}[A-Za-z0-9]")
CAPITALS = re.compile(r"[A-Z0-9]{16}")
CHANGE = re.compile(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")
RUN = re.compile(r"[A-Za-z0-9]{16,}")
#: What may follow a key: a quoted string, groups of digits and capitals, or a plain token; with a digit, if not quoted.
KEYED = re.compile(r"""(?:=>|[=:])[\x20\t]{0,4}(?:(["'`])([^\s"'`]{6,})\1|["'`]?([A-Z0-9]{2,}(?:[\x20-](?=[A-Z]*[0-9])[A-Z0-9]+)+(?![A-Za-z0-9_])|[A-Za-z0-9][A-Za-z0-9_+/.-]*[A-Za-z0-9]))""")
#: Keys that name a secret or a person's number (secret_keys). Looked for in the 48 characters before the sign.
SECRET = re.compile(
    r"(?:^|[^a-z0-9])(?:token|password|passwd|pwd|passphrase|secret|(?:api|access|private|auth|secret)[\x20_-]?(?:key|token)|ssn|iban|(?:social[\x20_-]security|passport|account)(?:[\x20_-](?:number|no\.?))?)"
    r"[\"']?[\x20\t]{0,4}$"
)
EDGE = ".,;!?\"'()[]{}#$%&*`"


def emails(text: str) -> list[tuple[int, int]]:
    """From each @: the run of local characters before it, and a dotted domain after it. Linear in any text."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        left = floor + len(text[floor:at].rstrip(LOCAL))
        floor = at + 1
        if left < at and (m := DOMAIN.match(text, at + 1)):
            out.append((left, m.end()))
            floor = m.end()
        at = text.find("@", floor)
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [(0, a, z) for a, z in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m.groups())]
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = re.sub(r"[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return out


def word(token: str) -> str:
    return token.strip(EDGE).lower()


def key_of(left: list[str]) -> str:
    """The key that ends the words left of a place, lower case: `token =`, `password=`; "" if there is none."""
    last = left[-1].lower() if left else ""
    if last in ("=", ":", "=>"):
        return f"{left[-2].lower()} {last}" if len(left) > 1 else ""
    return last if last and last[-1] in "=:" else ""


def named(pattern: str) -> str:
    """A pattern as it is stored: itself, or its hash if it is long."""
    return pattern if len(pattern) <= 120 else "#" + hashlib.sha256(pattern.encode()).hexdigest()[:40]


def patterns_of(left: list[str], right: list[str]) -> list[str]:
    """The lexical patterns of a place between two words at most on either side."""
    if key := key_of(left):
        return [named(key)]
    out = []
    after = word(right[0]) if right else ""
    if left and (one := word(left[-1])):
        out = [named(f"{word(left[-2]) if len(left) > 1 else '^'} {one} _"), named(f"{one} _ {after}")]
    if after and len(right) > 1:
        out.append(named(f"_ {after} {word(right[1])}"))
    return out


def looks(value: str) -> int:
    """2: no one has written this: a run of 16 letters and digits or more that change places at 45 of 100 places or more. 1: it
    may be so: they change places twice. 0: neither."""
    runs = [(len(CHANGE.findall(m[0])), len(m[0]) - 1) for m in RUN.finditer(value)]
    return 2 if any(100 * n >= 45 * places for n, places in runs) else int(any(n >= 2 for n, _ in runs))


def shape_of(value: str) -> str:
    """Alphabet (digits aside), length and up to four first capitals of a value of 16 characters or more; "" for a shorter one."""
    if len(value) < 16:
        return ""
    kinds = "".join(k for k, p in (("a", r"[a-z]"), ("A", r"[A-Z]"), ("-", r"[^A-Za-z0-9]")) if re.search(p, value))
    return named(f"shape {kinds} {len(value)} {re.match(r'[A-Z]{0,4}', value)[0]}")


class Places:
    """The words of a text, for the two on either side of a mention."""

    def __init__(self, text: str) -> None:
        self.text, spans = text, [m.span() for m in TOKEN.finditer(text)]
        self.starts, self.ends = [a for a, _ in spans], [z for _, z in spans]

    def around(self, start: int, end: int) -> tuple[list[str], list[str]]:
        """Words left and right; parts of the words that hold the mention count if more than brackets is left."""
        text, i = self.text, bisect_left(self.ends, start + 1)
        left = [text[self.starts[k] : self.ends[k]] for k in range(max(0, i - 2), i)]
        if i < len(self.starts) and self.starts[i] < start and (part := text[self.starts[i] : start].rstrip("\"'`([{")):
            left = [*left, part][-2:]
        j = bisect_left(self.starts, end)
        right = [text[self.starts[k] : self.ends[k]] for k in range(j, min(j + 2, len(self.starts)))]
        if j and self.ends[j - 1] > end and (part := text[end : self.ends[j - 1]].lstrip(EDGE)):
            right = [part, *right][:2]
        return left, right


def followers(text: str, before: set[str] | None, after: set[str] | None) -> Iterator[tuple[str, str]]:
    """(pattern, token) of the tokens of the text, in lower case, in each context behind a key, next behind a word of
    `before`, or next in front of a word of `after`; None: in every context."""
    words = text.lower().split()
    bare = [w.strip(EDGE) for w in words]
    n, keys = len(words), set()
    if "=" in text or ":" in text:
        for i, w in enumerate(words):
            if "=" in w or ":" in w:
                if w[-1] in "=:" or w == "=>":
                    keys.add(i + 1)
                for sign in "=:":
                    if 0 < (j := w.rfind(sign)) < len(w) - 1:
                        yield named(w[: j + 1]), w[j + 1 :].strip(EDGE)
    keys = {i: key for i in keys if i < n and (key := key_of(words[max(0, i - 2) : i]))}
    for i, key in keys.items():
        yield named(key), bare[i]
    for i in range(1, n):
        one = bare[i - 1]
        if one and (before is None or one in before) and i not in keys:
            yield named(f"{bare[i - 2] if i > 1 else '^'} {one} _"), bare[i]
            yield named(f"{one} _ {bare[i + 1] if i + 1 < n else ''}"), bare[i]
    for i in range(n - 2):
        one = bare[i + 1]
        if one and (after is None or one in after) and i not in keys:
            yield named(f"_ {one} {bare[i + 2]}"), bare[i]


def keyed(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, whether the key names a secret) of identifiers behind a key that no base span touches."""
    taken = sorted((a, z) for _, a, z in spans)
    out, i = [], 0
    for m in KEYED.finditer(text):
        a, z = m.span(2) if m[2] else m.span(3)
        secret = bool(SECRET.search(text[max(0, m.start() - 48) : m.start()].lower()))
        if not m[2] and (sum(map(str.isalnum, text[a:z])) < 6 or not DIGIT.search(text, a, z)):
            continue
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if not any(x < z and y > a for x, y in taken[i : i + 4]):
            out.append((a, z, secret))
    return out


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, how it looks) of identifier-like values that no base span touches."""
    taken = sorted((a, z) for _, a, z in spans)
    out, i = [], 0
    for token in TOKEN.finditer(text):
        if not DIGIT.search(token[0]) and not CAPITALS.search(token[0]):
            continue
        for m in VALUE.finditer(text, token.start(), token.end()):
            if not (LETTER.search(m[0]) and (DIGIT.search(m[0]) or len(m[0]) >= 16 and m[0].isupper())):
                continue
            while i < len(taken) and taken[i][1] <= m.start():
                i += 1
            if not any(a < m.end() and z > m.start() for a, z in taken[i : i + 4]):
                out.append((m.start(), m.end(), looks(m[0])))
    return out


SPAN = "array<struct<kind:int,start:int,end:int>>"
ADDED = "array<struct<kind:int,start:int,end:int,found:boolean>>"
MENTION = "array<struct<kind:int,start:int,end:int,seed:boolean,open:boolean,listed:boolean,patterns:array<string>,instance:string>>"


def mentions(docs: DataFrame, text_col: str, keep: list[str], secret_keys: bool) -> DataFrame:
    """The columns keep with __row (unique), __base (spans) and __seen (base spans and candidates, each with its
    patterns, whether it is a seed or may be generated, and the hash of its string); written."""
    inputs = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def mention(text: str, places: Places, kind: int, a: int, z: int, look: int = 2, listed: bool = False) -> dict:
            patterns = patterns_of(*places.around(a, z))
            if kind == 4 and (shape := shape_of(text[a:z])):
                patterns.append(shape)
            return {"kind": kind, "start": a, "end": z, "seed": look == 2, "open": look == 1, "listed": listed, "patterns": patterns, "instance": hashlib.sha256(text[a:z].encode()).hexdigest()[:24]}

        for b in batches:
            base, seen = [], []
            for x in b.column("__text"):
                text = x.as_py() or ""
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": z} for k, a, z in spans])
                own = [(a, z, looks(text[a:z]), secret_keys and x) for a, z, x in keyed(text, spans)] if "=" in text or ":" in text else []
                rest = candidates(text, [*spans, *((4, a, z) for a, z, *_ in own)]) if DIGIT.search(text) or CAPITALS.search(text) else []
                more = sorted((4, *x) for x in (*own, *rest))
                places = Places(text) if spans or more else None
                seen.append([mention(text, places, *s) for s in [*spans, *more]])
            i32, text_type = pa.int32(), pa.string()
            spot = [("kind", i32), ("start", i32), ("end", i32)]
            own = [pa.array(base, pa.list_(pa.struct(spot))), pa.array(seen, pa.list_(pa.struct([*spot, ("seed", pa.bool_()), ("open", pa.bool_()), ("listed", pa.bool_()), ("patterns", pa.list_(text_type)), ("instance", text_type)])))]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *own], [*keep, "__base", "__seen"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in inputs.schema if f.name in keep)
    found = inputs.mapInArrow(run, f"{fields}__base {SPAN}, __seen {MENTION}")
    return materialize(found.withColumn("__row", F.monotonically_increasing_id()), "pii-mentions")


def eligible(edges: DataFrame, support: float) -> DataFrame:
    """pattern, n_edges, n_seeds and n_open of the patterns that have enough instances; written."""
    number = lambda c: F.sum(F.col(c).cast("long"))
    counts = edges.where("pattern <> ''").groupBy("pattern").agg(F.count("*").alias("n_edges"), number("seed").alias("n_seeds"), number("open").alias("n_open"))
    return materialize(counts.where(F.col("n_edges") >= support), "pii-patterns")


def totals(docs: DataFrame, text_col: str, patterns: DataFrame, threshold: float, most_sent: int = 100_000) -> DataFrame:
    """The patterns with total, the number of all distinct tokens in their context, but for those whose total rules out
    that they ever reach the threshold (more than their instances over it).

    Up to most_sent patterns (120 characters each at most) travel with the tasks, which count each pattern's distinct
    tokens only until it is ruled out, so that a task sends rows in proportion to the patterns' instances. More patterns
    than that meet all contexts of the corpus in a join by the contexts' hash."""
    lexical = patterns.where(~F.col("pattern").startswith("shape "))
    most = F.floor(F.col("n_edges") / threshold).cast("long")
    shapes = patterns.where(F.col("pattern").startswith("shape ")).withColumn("total", F.col("n_edges"))
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    n = lexical.count()
    if not n:
        return shapes

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()), strict=True)], ["pattern", "token"])

    def digest(token: str) -> int:
        return int.from_bytes(hashlib.blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)

    def watched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, set[int] | None] = {}
        for b in batches:
            for x in b.column(0):
                for p, token in followers(x.as_py() or "", before, after):
                    if (top := limits.get(p)) is None or (own := found.setdefault(p, set())) is None:
                        continue
                    own.add(digest(token))
                    if len(own) > top:
                        found[p] = None  # ruled out
        for p, own in found.items():
            yield packed([(p, t) for t in own] if own is not None else [(p, None)])

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: set[tuple[str, int]] = set()
        for b in batches:
            for x in b.column(0):
                rows.update((p, digest(t)) for p, t in followers(x.as_py() or "", None, None))
                if len(rows) > 200_000:
                    yield packed(list(rows))
                    rows = set()
        yield packed(list(rows))

    if n <= most_sent:
        limits = {r[0]: r[1] for r in lexical.select("pattern", most).collect()}
        before = after = None  # a long pattern's words are not known
        if not any(p.startswith("#") for p in limits):
            before, after = ({w for p in limits for side, w in [_neighbour(p)] if side == k} for k in ("before", "after"))
        tokens = texts.mapInArrow(watched, "pattern string, token bigint")
    else:
        tokens = texts.mapInArrow(every, "pattern string, token bigint").join(lexical.select("pattern"), "pattern", "left_semi")
    # first the distinct tokens, so that a frequent context is not one task's
    each = tokens.groupBy("pattern", "token").agg(F.lit(1).alias("one")).groupBy("pattern")
    sums = each.agg(F.count("token").alias("n_tokens"), F.bool_or(F.col("token").isNull()).alias("out"))
    sized = lexical.join(sums, "pattern", "left").where(~F.coalesce("out", F.lit(False)))
    sized = sized.withColumn("total", F.greatest("n_edges", F.coalesce("n_tokens", F.lit(0)))).where(F.col("total") <= most)
    return materialize(sized.select("pattern", "n_edges", "n_seeds", "n_open", "total").unionByName(shapes), "pii-totals")


def _neighbour(pattern: str) -> tuple[str, str]:
    """On which side the word next to the place is that a pattern names, and that word; no side for a key."""
    if pattern.startswith("_ "):
        return "after", pattern.split(" ")[1]
    left, gap, _ = pattern.partition(" _")
    return ("before", left.split(" ")[-1]) if gap else ("", "")


def score_graph(edges: DataFrame, sizes: DataFrame, support: float, threshold: float, settled: float = 1e-3, salts: int = 16) -> DataFrame:
    """instance, seed and score of the instances that good patterns reach; a seed's own vote doesn't count for its score.
    edges: distinct pattern, instance, seed, open; sizes: pattern, n_seeds, n_open, total. Seeds count by their number alone;
    only edges of other instances take part in the rounds, which end when no score rises by more than `settled`. A pattern
    or an instance with very many edges is dealt to `salts` tasks: the short side of each join is repeated so often."""
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    salt = lambda of: F.pmod(F.xxhash64(of), F.lit(salts)).cast("int").alias("salt")
    useful = sizes.select("pattern", spread)
    met = edges.select("pattern", "instance", "seed", "open", salt("instance")).join(useful, ["pattern", "salt"], "left_semi")
    met = materialize(met.select("pattern", "instance", "seed", "open"), "pii-edges-met")
    open_ = met.where(~F.col("seed"))

    def reached(some: DataFrame, now: DataFrame, own: int) -> DataFrame:
        """Best confidence of the good patterns of each instance, `own` seeds taken out of each pattern."""
        mass = F.col("mass") - own
        confidence = mass / (mass + F.col("against") + 0.5)
        good = now.select("pattern", mass.alias("mass"), confidence.alias("confidence")).where((F.col("mass") >= support) & (F.col("confidence") >= threshold))
        pairs = some.withColumn("salt", salt("instance")).join(good.select("pattern", "confidence", spread), ["pattern", "salt"])
        return pairs.groupBy("instance").agg(F.max("confidence").alias("score"))

    scores = None
    while True:
        now = sizes.select("pattern", F.col("n_seeds").cast("double").alias("mass"), (F.col("total") - F.col("n_seeds") - F.col("n_open")).cast("double").alias("against"))
        if scores is not None:
            pairs = open_.withColumn("salt", salt("pattern")).join(scores.select("instance", "score", spread), ["instance", "salt"])
            doubtful = F.when(~F.col("open"), F.col("score")).otherwise(0.0)
            sums = pairs.groupBy("pattern").agg(F.sum("score").alias("found"), F.sum(doubtful).alias("freed"))
            now = now.join(sums, "pattern", "left").select("pattern", (F.col("mass") + F.coalesce("found", F.lit(0.0))).alias("mass"), (F.col("against") - F.coalesce("freed", F.lit(0.0))).alias("against"))
        new = materialize(reached(open_, now, 0), "pii-scores")
        if scores is None:
            risen = new.limit(1).count()
        else:
            before = scores.select("instance", F.col("score").alias("before"))
            risen = new.join(before, "instance", "left").where(F.col("score") > F.coalesce("before", F.lit(0.0)) + settled).limit(1).count()
        scores = new
        if not risen:
            seeds = reached(met.where("seed"), now, 1).select("instance", F.lit(True).alias("seed"), "score")
            return scores.select("instance", F.lit(False).alias("seed"), "score").unionByName(seeds)


def find_pii(
    docs: DataFrame, support: float = 3.0, threshold: float = 0.7, text_col: str = "text", carry: list[str] | None = None,
    names: tuple[str, str] = ("base", "added"), most_sent: int = 100_000, salts: int = 16, secret_keys: bool = True,
) -> DataFrame:
    """The columns `carry` of docs (all by default) with base and added (or other `names`): arrays of (kind, start,
    end), kinds numbered as in KINDS, code points, end exclusive; base by kind and start, added by start, with `found`: whether a
    pattern, not its own look, made it a span.

    support: a pattern must extract instances of at least this much score; threshold: least confidence of a pattern
    that adds instances; secret_keys: values of keys that name a secret are spans, too; most_sent and salts change where the work is done, not the result. Null and empty texts have no spans. Repeated rows get equal spans (their instances count
    once). An empty table gives an empty result. Columns of docs that have these names are replaced.
    """
    keep = [c for c in (docs.columns if carry is None else carry) if c not in names]
    table = mentions(docs, text_col, keep, secret_keys)
    seen = table.select(F.explode("__seen").alias("m")).select(F.explode_outer("m.patterns").alias("pattern"), "m.instance", "m.seed", "m.open", "m.listed").fillna("", ["pattern"])
    grades = [F.max("seed").alias("seed"), (F.max("open") & ~F.max("seed")).alias("open"), F.max("listed").alias("listed")]
    edges = materialize(seen.groupBy("pattern", "instance").agg(*grades), "pii-edges")
    patterns = eligible(edges, support)
    unsure = F.filter("__seen", lambda m: m["kind"] == 4)
    none = F.array().cast(ADDED)
    sure = F.transform(F.filter("__seen", lambda m: (m["kind"] == 4) & m["seed"]), lambda m: F.struct(m["kind"], m["start"], m["end"], F.lit(False).alias("found")))
    both = lambda added: [F.col("__base").alias(names[0]), added.alias(names[1])]
    plain = table.where(F.size(unsure) == 0).select(*keep, *both(none))
    rest = table.where(F.size(unsure) > 0)
    # what is found in one place is known elsewhere, too: a seed's string, and an instance of a good pattern
    found = score_graph(edges, totals(docs, text_col, patterns, threshold, most_sent), support, threshold, salts=salts).where(~F.col("seed")).select("instance")
    found = found.select("instance", F.lit(True).alias("found")).unionByName(edges.where("seed OR listed").select("instance", F.lit(False).alias("found")).distinct())
    found = found.groupBy("instance").agg(F.max("found").alias("found"))
    spots = rest.select("__row", F.explode(F.filter(unsure, lambda m: ~m["seed"])).alias("m")).select("__row", "m.kind", "m.start", "m.end", "m.instance")
    spots = spots.withColumn("__salt", F.pmod(F.xxhash64("__row"), F.lit(salts)).cast("int"))
    found = found.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spans = spots.join(found, ["instance", "__salt"]).groupBy("__row").agg(F.collect_list(F.struct("kind", "start", "end", "found")).alias("__added"))
    rest = rest.join(spans, "__row", "left").select(*keep, *both(F.array_sort(F.concat(sure, F.coalesce("__added", none)))))
    return plain.unionByName(rest)


def redact(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs with every span of the text replaced by its kind in brackets; overlapping spans become one, named after the
    first. Columns are those of docs; n_chars, if there, follows the text; a null text stays null."""
    found = find_pii(docs, text_col=text_col, names=("__found", "__more"), **options)
    spans = F.array_sort(F.concat(F.transform("__found", lambda s: F.struct(s["start"], s["end"], s["kind"])), F.transform("__more", lambda s: F.struct(s["start"], s["end"], s["kind"]))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    # overlapping spans as one: a span begins a new one if it starts where none before it reaches
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,end:int,kind:int>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        apart = F.struct(s["end"].alias("end"), F.array_append(acc["out"], F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).alias("out"))
        last = F.element_at(acc["out"], -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        joined = F.struct(F.greatest(acc["end"], s["end"]).alias("end"), F.array_append(F.slice(acc["out"], F.lit(1), F.size(acc["out"]) - 1), wider).alias("out"))
        return F.when((s["start"] >= acc["end"]) | (F.size(acc["out"]) == 0), apart).otherwise(joined)

    def merged(all_: Column) -> Column:
        plain = F.transform(all_, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        crossing = F.exists(F.transform(all_, lambda s, i: (i > 0) & (F.get(all_, i - 1)["end"] > s["start"])), lambda x: x)
        return F.when(crossing, F.aggregate(all_, start, step, lambda acc: acc["out"])).otherwise(plain)

    def parts(m: Column) -> Column:
        text = F.col(text_col)
        before = lambda x, i: F.when(i == 0, F.lit(0)).otherwise(F.get(m, i - 1)["end"])
        pieces = F.transform(m, lambda x, i: F.concat(F.substring(text, before(x, i) + 1, x["start"] - before(x, i)), F.get(names, x["kind"])))
        return F.concat(F.array_join(pieces, ""), F.substring(text, F.element_at(m, -1)["end"] + 1, F.lit(2**31 - 1)))

    cut = let(let(spans, merged), parts)
    out = found.withColumn(text_col, F.when(F.size(spans) > 0, cut).otherwise(F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op6_bootstrapped_contexts(spark, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"])
    kinds = F.array(*[F.lit(k) for k in KINDS])
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(written(F.col("base")), F.lit("")), F.nullif(written(F.col("added")), F.lit(""))).alias("spans"),
        F.size("added").cast("long").alias("n_id"), F.size(F.filter("added", lambda s: s["found"])).cast("long").alias("n_found"), (F.size("base") + F.size("added")).cast("long").alias("n_spans"),
    )
