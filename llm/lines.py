"""Fuzzy line dedup in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.carrying import carrying
from llm.linking import bucket_members, linked_alike, with_mates
from llm.quality import SPACE, has_word, let
from llm.scratch import Scratch

# A pair of similarity 0.8 shares no bucket with a chance of 8e-4, one of 0.9 with 2e-6.
BANDS, ROWS = 10, 3
# A pair is compared in full if so many of its BANDS x ROWS minima agree in MARK_BITS bits, as
# they tell by MARKS numbers.  One of similarity 0.8 has fewer with a chance of 1e-5.  Lines that only meet in a bucket
# grow with the square of the input, so that the bits are more than links alone would need.
ALIKE, MARK_BITS = 14, 8
MARKS = tuple(f"m{k}" for k in range(-(-BANDS * ROWS // (64 // MARK_BITS))))
# Hashes of shingles fall into 2**BIN_BITS bins.  Sets that fill at least BINS of them have minima of bins, those that
# fill no more than FILLED have minima of permutations, and those between have both: two sets of
# similarity 0.8 are not so far apart that they have no kind in common.  Bins are counted in groups, by their first
# GROUP_BITS.
BIN_BITS, GROUP_BITS, BINS, FILLED = 5, 3, 24, 29
# Characters of a shingle; a shorter line is its one shingle.
SHINGLE = 5
# Lines of so many characters have minima of permutations at once; of longer ones only those that
# are found to fill few bins.
PIECE = 128
# Lines of fewer normalised characters stay: only blank ones, which part paragraphs.
LEAST_CHARS = 1
# Rows of two or three numbers that are sent to all executors (some 32 bytes each); beyond
# that the same join is shuffled.
BROADCAST_ROWS = 1_000_000
ADDED = ("n_lines", "n_removed")
_BLANKS = " \t\x0b\x0c\r"
# Odd multipliers below 2**31: products with 32-bit hashes stay below 2**63.
_MULTIPLIERS = [(0x2545F491 * (2 * k + 1) * (2 * k + 3) + 0x1B873594 * k) % (1 << 31) | 1
                for k in range(BANDS * ROWS)]
_LOW = (1 << 32) - 1


def _plain(lowered: Column) -> Column:
    """White space runs as one space; no regular expression where none is needed."""
    odd = lowered.contains("  ")
    for c in _BLANKS[1:]:
        odd = odd | lowered.contains(c)
    return F.trim(F.when(odd, F.regexp_replace(lowered, SPACE, " ")).otherwise(lowered))


# Four bytes a character: a character's place is known without counting from the start.
_WIDE = "UTF-32"


def _last(wide: Column) -> Column:
    """Where the last shingle of a line in wide characters begins, in bytes from 1."""
    return F.greatest(F.length(wide) - 4 * SHINGLE + 1, F.lit(1))


def _run(wide: Column, at: Column) -> Column:
    return F.substr(wide, at, F.lit(4 * SHINGLE))


def shingles(norm: Column) -> Column:
    """Hashes of the distinct character runs of a normalised line, from every position."""

    def each(wide: Column) -> Column:
        at = F.sequence(F.lit(1), _last(wide), F.lit(4))
        return F.transform(at, lambda i: F.xxhash64(_run(wide, i)))

    return F.array_distinct(let(F.encode(norm, _WIDE), each))


def _document() -> list[Column]:
    """What tells documents apart; equal rows are one document."""
    return [
        F.col("doc_id").isNull().alias("late"),
        F.col("doc_id"),
        F.xxhash64("text").alias("version"),
    ]


def _lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(late, doc_id, version, at, line, k1, k2) of all lines that can be copies."""
    # Split before exploding, so that the text is not copied and hashed for each line.
    whole = docs.select(*_document(), F.split(F.lower("text"), "\n").alias("lines"))
    rows = whole.select("late", "doc_id", "version", F.posexplode("lines").alias("at", "raw"))
    # Blank lines are told before they are normalised: a filter would do that a second time.
    rows = rows.filter(F.trim("raw", F.lit(_BLANKS)) != "")
    kept = rows.select("late", "doc_id", "version", "at", _plain(F.col("raw")).alias("line"))
    if least_chars > 1:
        kept = kept.filter(F.length("line") >= least_chars)
    return kept.select(
        "*", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit("second"), "line").alias("k2")
    )


def _place() -> Column:
    return F.struct("late", "doc_id", "version", "at")


def _hashes(distinct: DataFrame) -> DataFrame:
    """(k1, k2, at, x): 32-bit hashes of all shingles of the lines and their places in bytes."""
    wide = distinct.select("k1", "k2", F.encode("line", _WIDE).alias("wide"))
    places = F.sequence(F.lit(1), _last(F.col("wide")), F.lit(4))
    each = wide.select("k1", "k2", "wide", F.explode(places).alias("at"))
    return each.select("k1", "k2", "at", F.hash(_run(F.col("wide"), F.col("at"))).alias("x"))


def _signed(minima: DataFrame, kind: int) -> DataFrame:
    """(node, kind, bands, marks) of the minima m0, m1 and so on; the last bit of a band is its kind."""
    n = BANDS * ROWS
    bands = [
        F.shiftleft(F.xxhash64(F.lit(b), *[f"m{b + r * BANDS}" for r in range(ROWS)]), 1)
        .bitwiseOR(F.lit(kind))
        for b in range(BANDS)
    ]
    lanes = 64 // MARK_BITS
    marks = []
    for name, first in zip(MARKS, range(0, n, lanes), strict=True):
        mark = F.lit(0).cast("bigint")
        for k in range(first, min(first + lanes, n)):
            bits = F.col(f"m{k}").bitwiseAND(F.lit((1 << MARK_BITS) - 1))
            mark = mark.bitwiseOR(F.shiftleft(bits, MARK_BITS * (k - first)))
        marks.append(mark.alias(name))
    return minima.select(
        F.col("k1").alias("node"),
        F.lit(kind).cast("bigint").alias("kind"),
        F.array(*bands).alias("bands"),
        *marks,
        *[c for c in ("filled", "last") if c in minima.columns],
    )


def _binned(distinct: DataFrame) -> DataFrame:
    """(node, kind, bands, marks, filled, last): minima of bins, how many are filled, the last place.

    A hash belongs to the bin of its first BIN_BITS.  The minimum for a bin is the hash nearest to
    where it begins, by exclusive or: one of the bin itself unless that is empty.  So it is the
    minimum of a permutation of all hashes.  It is taken within groups of bins first, which leaves
    few rows of a line for the minima of all bins.
    """
    low, high = 32 - BIN_BITS, 32 - GROUP_BITS
    own = range(1 << BIN_BITS - GROUP_BITS)
    groups = (
        _hashes(distinct)
        .select("k1", "k2", "at", "x", F.shiftrightunsigned("x", high).alias("group"))
        .groupBy("k1", "k2", "group")
        .agg(
            F.max("at").alias("last"),
            # Signs do not matter within a group.
            *[F.min(F.col("x").bitwiseXOR(F.lit(j << low))).alias(f"x{j}") for j in own],
        )
    )
    inside = [F.shiftrightunsigned(f"x{j}", low).bitwiseAND(F.lit(len(own) - 1)) == 0 for j in own]
    filled = inside[0].cast("int")
    for x in inside[1:]:
        filled = filled + x.cast("int")
    rows = groups.select(
        "k1",
        "k2",
        "last",
        filled.alias("filled"),
        *[F.col(f"x{j}").cast("bigint").bitwiseAND(F.lit(_LOW)).alias(f"x{j}") for j in own],
    )
    minima = rows.groupBy("k1", "k2").agg(
        F.sum("filled").cast("int").alias("filled"),
        F.max("last").alias("last"),
        *[
            F.min(F.col(f"x{k % len(own)}").bitwiseXOR(F.lit(k // len(own) << high))).alias(f"m{k}")
            for k in range(BANDS * ROWS)
        ],
    )
    return _signed(minima, 0)


def _permuted(distinct: DataFrame) -> DataFrame:
    """(node, kind, bands, marks): minima of BANDS x ROWS permutations, for lines with few shingles."""
    x = F.col("x").cast("bigint").bitwiseAND(F.lit(_LOW))
    minima = (
        _hashes(distinct)
        .groupBy("k1", "k2")
        .agg(
            *[
                F.min((x * F.lit(a)).bitwiseAND(F.lit(_LOW))).alias(f"m{k}")
                for k, a in enumerate(_MULTIPLIERS)
            ]
        )
    )
    return _signed(minima, 1)


def _signatures(lines: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """(node, kind, bands, marks): MinHash bands and marks of all distinct lines; node is k1.

    Also the written tables that hold them.

    One shuffle brings equal lines together.  What follows stays in its partitions.
    """
    distinct = lines.groupBy("k1", "k2").agg(F.first("line").alias("line"))
    # Longer lines of few shingles repeat them; they are read once more.
    binned = _binned(distinct)
    permuted = _permuted(distinct.filter(F.length("line") <= PIECE))
    for name in ("filled", "last"):
        permuted = permuted.withColumn(name, F.lit(None).cast("int"))
    found = scratch.write(binned.unionByName(permuted))
    again = found.filter((F.col("filled") <= FILLED) & (F.col("last") > 4 * (PIECE - SHINGLE) + 1))
    signed = found.filter(F.coalesce(F.col("filled") >= BINS, F.lit(True)))
    signed = signed.select("node", "kind", "bands", *MARKS)
    if again.limit(1).count():
        again = scratch.write(again.select(F.col("node").alias("k1")).distinct())
        few = lines.filter(F.length("line") > PIECE).join(small(again), "k1", "left_semi")
        few = few.groupBy("k1", "k2").agg(F.first("line").alias("line"))
        more = scratch.write(_permuted(few))
        scratch.drop(again)
        return signed.unionByName(more), [found, more]
    return signed, [found]


def _alike(x: str, y: str) -> Column:
    """Whether at least ALIKE minima of two rows agree, by their marks."""
    lanes = 64 // MARK_BITS

    def differing(name: str, n: int) -> Column:
        v = F.col(f"{x}.{name}").bitwiseXOR(F.col(f"{y}.{name}"))
        step = MARK_BITS
        while step > 1:
            step //= 2
            v = v.bitwiseOR(F.shiftrightunsigned(v, step))
        return F.bit_count(v.bitwiseAND(F.lit(sum(1 << MARK_BITS * k for k in range(n)))))

    n = BANDS * ROWS
    found = [differing(m, min(lanes, n - lanes * k)) for k, m in enumerate(MARKS)]
    return sum(found[1:], found[0]) <= n - ALIKE


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, a written table, marked for broadcast if it is counted to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def removals(
    docs: DataFrame,
    threshold: float,
    scratch: Scratch,
    *,
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """(late, doc_id, version, removed): positions of lines to remove, by document."""
    lines = _lines(docs, least_chars)
    # Written before bands are dealt: the lines' shuffle is over by then.
    signatures, tables = _signatures(lines, scratch)
    buckets = signatures.select(F.explode("bands").alias("bucket"), "node")
    shared = scratch.write(bucket_members(buckets, preaggregate=False))
    # Most bands are no other line's; marks need not be moved for those.
    marks = signatures.select("node", "kind", *MARKS)
    marked = scratch.write(
        shared.withColumn("kind", F.col("bucket").bitwiseAND(F.lit(1)))
        .join(marks, ["node", "kind"])
        .select("bucket", "hub", "node", *MARKS)
    )
    for superseded in (shared, *tables):
        scratch.drop(superseded)
    members = scratch.write(with_mates(marked, _alike))
    scratch.drop(marked)
    wanted = scratch.write(members.select("node").distinct())
    places = scratch.write(lines.select("k1", "k2", "late", "doc_id", "version", "at"))
    # One document for each line to compare; only these are read again.
    holders = scratch.write(
        places.select(F.col("k1").alias("node"), "version")
        .join(small(wanted), "node", "left_semi")
        .groupBy("node")
        .agg(F.min("version").alias("version"))
        .select("version")
        .distinct()
    )
    held = docs.withColumn("_text", F.xxhash64("text")).join(
        small(holders.withColumnRenamed("version", "_text")), "_text", "left_semi"
    )
    # The lines themselves: their shingles would take many times the room in the joins.
    texts = scratch.write(
        _lines(held, least_chars)
        .select(F.col("k1").alias("node"), "line")
        .join(small(wanted), "node", "left_semi")
        .groupBy("node")
        .agg(F.first("line").alias("line"))
    )
    for superseded in (holders, wanted):
        scratch.drop(superseded)

    def joined(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("node").alias("a"), F.col("line").alias("line_a"))
        right = texts.select(F.col("node").alias("b"), F.col("line").alias("line_b"))
        return pairs.join(right, "b").join(left, "a")

    def sets(pairs: DataFrame) -> DataFrame:
        x, y = shingles(F.col("line_a")).alias("x"), shingles(F.col("line_b")).alias("y")
        return joined(pairs).select("a", "b", x, y)

    def verify(pairs: DataFrame) -> DataFrame:
        same = sets(pairs).select(
            "a",
            "b",
            (F.size("x") + F.size("y")).alias("both"),
            F.size(F.array_intersect("x", "y")).alias("same"),
        )
        similarity = F.col("same") / (F.col("both") - F.col("same"))
        return same.select("a", "b", similarity.alias("similarity"))

    def differ(pairs: DataFrame) -> DataFrame:
        return sets(pairs).select(
            "a",
            "b",
            F.size("x").cast("bigint").alias("size_a"),
            F.array_except("x", "y").alias("lost"),
            F.array_except("y", "x").alias("gained"),
        )

    placed = linked_alike(members, _alike, verify, differ, threshold, scratch)
    distinct = places.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n"), F.min(_place()).alias("first")
    )
    grouped = scratch.write(
        distinct.alias("d")
        .join(placed.alias("p"), F.col("d.k1") == F.col("p.node"), "left")
        .select("d.*", F.coalesce("p.component", "d.k1").alias("component"))
    )
    for superseded in (members, texts):
        scratch.drop(superseded)
    roots = grouped.groupBy("component").agg(
        F.min("first").alias("keeper"), F.sum("n").alias("rows")
    )
    keepers = scratch.write(
        grouped.join(roots.filter("rows > 1"), "component").select("k1", "k2", "keeper")
    )
    found = places.select("k1", "k2", _place().alias("place")).join(small(keepers), ["k1", "k2"])
    return scratch.write(
        found.filter(F.col("place") != F.col("keeper"))
        .groupBy("place.late", "place.doc_id", "place.version")
        .agg(F.collect_set("place.at").alias("removed"))
    )


@carrying(*ADDED)
def line_dedup(
    docs: DataFrame,
    *,
    threshold: float = 0.8,
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """`docs` with repeated lines taken out of `text`, n_lines and n_removed.

    Lines are compared in lower case with single spaces.  Their shingles are the
    distinct runs of SHINGLE characters from each character on (a shorter line is one shingle);
    lines with a Jaccard similarity of `threshold` or more are linked.  Of each component the line
    that comes first by doc_id and place stays.

    Blank lines stay, and with a larger `least_chars` all lines of fewer characters (headings, say).
    n_lines counts all lines (parts
    between line feeds), n_removed those taken out.  A null text stays null with 0 lines, an empty one
    is one empty line; a line may be of any length.  An empty table stays empty.  Of documents that repeat a doc_id, the text's hash decides which
    comes first; fully equal rows are one document and lose the same lines.  A null doc_id comes
    last.  Other columns pass through; existing columns of the added names are replaced.

    Equal lines are one node, known by a 64-bit hash in links and 128 bits otherwise.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    gone = removals(docs, threshold, scratch, least_chars=least_chars).alias("g")
    base = docs.drop(*ADDED)
    late, _, version = _document()
    own = base.withColumns({"_late": late, "_version": version}).alias("d")
    joined = own.join(
        small(gone, BROADCAST_ROWS // 4),
        (F.col("d._late") == F.col("g.late"))
        & F.col("d.doc_id").eqNullSafe(F.col("g.doc_id"))
        & (F.col("d._version") == F.col("g.version")),
        "left",
    )
    lines = F.split("d.text", "\n")

    def rest(parts: Column) -> Column:
        at = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("g.removed"))
        return F.transform(at, lambda i: F.get(parts, i))

    text = F.when(F.col("g.removed").isNull(), F.col("d.text")).otherwise(
        F.array_join(let(lines, rest), "\n")
    )
    return joined.select(
        *[text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in base.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("g.removed"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def without_empty(found: DataFrame) -> DataFrame:
    """Rows of `line_dedup` without documents that lost their last line with a word."""
    return found.filter((F.col("n_removed") == 0) | has_word(F.col("text")))
