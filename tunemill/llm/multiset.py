"""Homomorphic multiset fingerprints of documents (native Spark functions only).

A paragraph (a line) is hashed to a wide vector: ``EXACT`` numbers modulo 2**48, each an independently seeded hash of the
whole paragraph, and ``PACKED`` numbers modulo 2**60 that add up 0/1 lanes hashed from its runs of words. The fingerprint of
a document is the sum of its paragraphs' vectors, so it does not depend on their order, and a paragraph is put in or taken
out by adding or subtracting its vector (``add``, ``subtract``). The 0/1 lanes, two of 30 bits in each packed number, are
read as random signs; the cosine of two documents' lanes estimates how much of their runs they share, within about 0.065.

Runs do not overlap: up to three words from the start of a sentence on, so a change costs the rest of its sentence at most.
A sentence ends at the end of a line or at a sentence mark, a run also after 16 characters without a blank, so scripts
without blanks have runs too.

Defined cases: a null text counts as empty; an empty text has one empty paragraph; equal texts have equal fingerprints;
blank paragraphs have no runs, and a text without any is like none but its equals; lanes hold 1,073,741,823 runs. The
document after the last is the first; a single document follows itself; a null id comes first; rows with one id are ordered
by hash and text. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import partitions

EXACT, WORDS, SHIFTS, LANE = 8, 4, 30, 30
PACKED = WORDS * SHIFTS
EXACT_MASK, PACKED_MASK, LANE_MASK = (1 << 48) - 1, (1 << 60) - 1, (1 << LANE) - 1
#: Up to two words that end no sentence, each with blanks after it, and one more; or a piece of a text without blanks.
RUN = r"(?:\S{0,15}[^\s.!?。！？][^\S\n]+){0,2}(?:[^\s。！？]{0,15}[。！？]|\S{1,16})"
#: So many 0/1 lanes add up in 4 bits.
CHUNK = 15
NIBBLES = sum(1 << (4 * i) for i in range(15))
SMALLEST = -(1 << 63)


def _longs(values) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _sum(units: Column, width: int, vector, mask: int) -> Column:
    """Sum of the vectors of ``units``, number by number; masked at each step, so it never overflows."""
    return F.aggregate(units, F.array_repeat(F.lit(0).cast("long"), width),
                       lambda acc, unit: F.zip_with(acc, vector(unit), lambda a, b: (a + b).bitwiseAND(F.lit(mask))))


def exact_vector(paragraph: Column) -> Column:
    return F.array(*[F.xxhash64(F.lit(i), paragraph).bitwiseAND(F.lit(EXACT_MASK)) for i in range(EXACT)])


def _chunk_sum(hashes: Column) -> Column:
    """Lanes of at most ``CHUNK`` runs: 15 lanes of 4 bits in each number, four numbers for each hash."""
    return F.aggregate(hashes, F.array_repeat(F.lit(0).cast("long"), 4 * WORDS), lambda acc, h: F.array(
        *[acc[4 * w + s] + F.shiftrightunsigned(h[w], s).bitwiseAND(F.lit(NIBBLES)) for w in range(WORDS) for s in range(4)]))


def _packed(chunk: Column) -> Column:
    """The lanes of a chunk as ``PACKED`` numbers: bits i and i + 30 of a hash are the lanes of number i."""
    lane = lambda w, bit: F.shiftrightunsigned(chunk[4 * w + bit % 4], 4 * (bit // 4)).bitwiseAND(F.lit(15))
    return F.array(*[lane(w, i) + F.shiftleft(lane(w, i + LANE), LANE) for w in range(WORDS) for i in range(SHIFTS)])


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also inside functions of elements."""
    return F.transform(F.array(value), use)[0]


def sign_sum(runs: Column) -> Column:
    """Sum of the lanes of all runs."""
    hashes = F.transform(runs, lambda run: F.array(*[F.xxhash64(F.lit(100 + i), run) for i in range(WORDS)]))
    chunks = _once(hashes, lambda all_: F.transform(F.sequence(F.lit(0), F.floor(F.size(all_) / CHUNK).cast("int")),
                                                    lambda i: _chunk_sum(F.slice(all_, i * CHUNK + 1, CHUNK))))
    return _sum(chunks, PACKED, _packed, PACKED_MASK)


def fingerprint(text: Column) -> Column:
    """struct(exact, signs, n): the vector of a text, n its number of runs."""
    whole = F.coalesce(text, F.lit(""))
    runs = F.regexp_extract_all(whole, F.lit(RUN), F.lit(0))
    return _once(runs, lambda found: F.struct(
        _sum(F.split(whole, "\n"), EXACT, exact_vector, EXACT_MASK).alias("exact"), sign_sum(found).alias("signs"),
        F.size(found).cast("long").alias("n")))


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the documents' paragraphs together."""
    plus = lambda mask: lambda x, y: (x + y).bitwiseAND(F.lit(mask))
    return F.struct(F.zip_with(a["exact"], b["exact"], plus(EXACT_MASK)).alias("exact"),
                    F.zip_with(a["signs"], b["signs"], plus(PACKED_MASK)).alias("signs"), (a["n"] + b["n"]).alias("n"))


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` without the paragraphs of ``b``."""
    minus = lambda mask: lambda x, y: (x - y).bitwiseAND(F.lit(mask))
    return F.struct(F.zip_with(a["exact"], b["exact"], minus(EXACT_MASK)).alias("exact"),
                    F.zip_with(a["signs"], b["signs"], minus(PACKED_MASK)).alias("signs"), (a["n"] - b["n"]).alias("n"))


def as_text(print_: Column) -> Column:
    """The whole vector in lower-case hexadecimal digits, then the number of runs."""
    pad = lambda column, width: F.array_join(F.transform(column, lambda x: F.lpad(F.hex(x), width, "0")), "")
    return F.lower(F.concat(pad(print_["exact"], 12), pad(print_["signs"], 15), F.lit("-"), F.hex(print_["n"])))


def _lanes(print_: Column) -> Column:
    """Sums of random signs: set lanes minus clear lanes."""
    return F.flatten(F.transform(print_["signs"], lambda x: F.array(
        *[F.shiftright(x, LANE * i).bitwiseAND(F.lit(LANE_MASK)) * 2 - print_["n"] for i in range(2)])))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of the sign lanes; 1 for equal vectors."""
    x, y = _lanes(a), _lanes(b)
    size = F.sqrt(_dot(x, x) * _dot(y, y))
    same = (a["exact"] == b["exact"]) & (a["signs"] == b["signs"]) & (a["n"] == b["n"])
    return F.when(same, 1.0).when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), _dot(x, y) / size))).otherwise(0.0)


def _bucket(key: Column, cuts: list[int]) -> Column:
    """Number of cuts below ``key``, by binary search."""
    if not cuts:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    table = _longs(cuts)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(
        (at + s <= len(cuts)) & (F.get(table, at + s - 1) < key), at + s).otherwise(at))


def with_next(docs: DataFrame, key: Column, columns: list[str], tie: Column) -> DataFrame:
    """Each row with ``next_<column>`` of the row after it in ascending ``key``; after the last comes the first.

    Rows are dealt into ranges of the key, one shuffle in all; the first rows of a range are also sent to the range before
    it. Cut points and first keys are one number per range.
    """
    keyed = docs.withColumn("order_key", F.coalesce(key, F.lit(SMALLEST)))
    n = partitions(docs.sparkSession)
    narrow = keyed.select("order_key")
    shares = [i / n for i in range(1, n)]
    cuts = sorted(set(narrow.agg(F.percentile_approx("order_key", shares, 100 * n)).first()[0] or [])) if shares else []
    placed = _bucket(F.col("order_key"), cuts)
    firsts = dict(sorted((b, k) for b, k in narrow.groupBy(placed.alias("b")).agg(F.min("order_key")).collect()))
    used = list(firsts)
    before = {b: used[i - 1] for i, b in enumerate(used)}
    first = _longs([firsts.get(b, SMALLEST) for b in range(len(cuts) + 1)])
    back = F.array(*[F.lit(before.get(b, 0)) for b in range(len(cuts) + 1)])
    here = keyed.withColumn("range", placed)
    real = F.struct(F.col("range").alias("range"), F.lit(0).alias("guest"))
    guest = F.struct(F.get(back, F.col("range")).alias("range"), F.lit(1).alias("guest"))
    dealt = here.select(*docs.columns, "order_key", F.explode(
        F.when(F.col("order_key") == F.get(first, F.col("range")), F.array(real, guest)).otherwise(F.array(real))).alias("place"))
    order = Window.partitionBy("range").orderBy("guest", "order_key", tie)
    return (dealt.select(*docs.columns, "order_key", "place.range", "place.guest")
            .select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
            .where("guest = 0").drop("order_key", "range", "guest"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every document and of its edited text, with their likeness and that of the next document."""
    whole = docs.select(F.col(key).alias("doc_key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    prints = whole.withColumn("print", fingerprint(F.col("body")))
    both = (with_next(prints, F.col("doc_key").cast("long"), ["body", "print"], F.struct(F.xxhash64("body"), "body"))
            .withColumn("new_body", edited(F.col("body"), F.col("next_body")))
            .withColumn("new_print", fingerprint(F.col("new_body"))))
    return both.select(
        F.col("doc_key").alias(key), F.length("body").cast("long").alias("n_chars"),
        F.sha2(F.col("new_body"), 256).alias("edited_sha256"), as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("new_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("new_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"))
