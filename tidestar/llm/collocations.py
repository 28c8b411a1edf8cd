"""Phrase collocations from rolling fingerprints.

1. Texts are cut into pieces and words once; the words' 64-bit hashes are stored, with a zero between pieces.
2. For each phrase length a pass over the stored hashes takes the fingerprint of every n-gram from prefix sums of a
   polynomial modulo 2**64. Tasks send 32 bits of each fingerprint with its count, and the shuffle adds the counts up.
3. A phrase is no more frequent than its parts, so an n-gram is sent only where both its shorter parts may be frequent.
   That is looked up in a bitmap of fixed size: a false hit costs a row, and no frequent phrase is missed.
4. A pass over the texts finds the occurrences of frequent fingerprints. In a slice each fingerprint points to its first
   occurrence; the words of all others are compared with the words there, and those that differ count by their own
   words. Only these phrases are made into strings, and the second shuffle adds them up by their text, with a document that
   holds them. So counts are exact, whatever the fingerprints do.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidestar.llm.batches import bounded_batches, map_slices
from tidestar.llm.forest import mixed
from tidestar.session import stored, work_dir

LONGEST = 4
LEAST, SHARE, BEST = 30, 80, 2000
BASE = np.uint64(0x9E3779B97F4A7C15)
PARTS = 64  #: of a language's phrases, ranked apart first
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
#: Bits of a fingerprint that count: they compress better than all 64, and what collides is told apart by the text.
KEPT = np.uint64(2**32 - 1)
#: Bits of the bitmap of frequent fingerprints: 8 MB, whatever the data.
BITS = 1 << 26
CACHE_WORDS = 150_000
#: Bytes of text that a task takes at a time; its tokens take some fifteen times as much.
SLICE = 2_000_000
#: Of the stored hashes, whose rows are some megabytes each: a writer holds a row group, and a reader unfolds up to 4,096 rows
#: of one at once, so groups have few rows and bytes, and are measured at each row, not after a hundred.
ROW_GROUPS = {
    "parquet.compression.codec.zstd.level": "6",
    "parquet.page.size": "8000000",
    "parquet.block.row.count.limit": "16",
    "parquet.block.size": "4000000",
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}
#: Fingerprints that a task holds before it sends them.
HELD = 2_000_000
#: Of these with their counts, those that go to the executor at a time.
SENT = 100_000

TOKEN = re.compile(rb"[^ \n]+|\n")
MARK = b"\n"
CLEAN = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", MARK * 9 + b" ")


class Words(dict):
    """Serial numbers of words as they come, and their hashes by number; the mark between pieces is number 0."""

    def __init__(self) -> None:
        self.hashes = [0]
        self[MARK] = 0

    def __missing__(self, word: bytes) -> int:
        self.hashes.append(xxhash.xxh3_64_intdigest(word) or 1)
        self[word] = number = len(self.hashes) - 1
        return number


def tokens(text: str | None) -> list[bytes]:
    """The words of a text with a mark after each piece."""
    return [*TOKEN.findall(text.encode("utf-8", "surrogatepass").lower().translate(CLEAN)), MARK] if text else []


class Cutter:
    """Cuts the texts of a slice, by language: tokens, their serial numbers and hashes, and where each text starts."""

    def __init__(self) -> None:
        self.words = Words()

    def __call__(self, rows: dict[str, list]) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray, np.ndarray, list]]:
        if len(self.words) > CACHE_WORDS:
            self.words = Words()
        groups: dict[str, list[int]] = {}
        for at, lang in enumerate(rows["lang"]):
            groups.setdefault(lang, []).append(at)
        for lang, at in groups.items():
            held: list[bytes] = []
            starts = []
            for i in at:
                starts.append(len(held))
                held += tokens(rows["text"][i])
            serial = np.fromiter(map(self.words.__getitem__, held), np.int64, len(held))
            yield lang, held, serial, np.array(self.words.hashes, np.uint64)[serial], np.array(starts), at


class Prints:
    """Fingerprints of n-grams from prefix sums of ``hash * BASE**-place``."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def __call__(self, hashes: np.ndarray, lang: str, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprint at every place, and whether the n-gram there lies within a piece."""
        n = len(hashes)
        if n < length:
            return np.empty(0, np.uint64), np.empty(0, bool)
        if n > len(self.powers):
            full = np.ones(2 * n, np.uint64)
            full[1:] = BASE
            self.powers = np.multiply.accumulate(full)
            full[1:] = INVERSE
            self.inverses = np.multiply.accumulate(full)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self.inverses[:n], out=sums[1:])
        polynomial = (sums[length:] - sums[:-length]) * self.powers[length - 1 : n]
        there = np.zeros(n + 1, np.int64)
        np.cumsum(hashes != 0, out=there[1:])
        seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), seed=length))
        return mixed(polynomial ^ seed) & KEPT, there[length:] - there[:-length] == length


class Bitmap:
    """The cells of frequent fingerprints."""

    def __init__(self, cells: bytes) -> None:
        self.cells = np.frombuffer(cells, np.uint8)

    def __call__(self, prints: np.ndarray) -> np.ndarray:
        cell = prints & np.uint64(BITS - 1)
        return (self.cells[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap(frequent: DataFrame) -> bytes:
    """A bit for each cell with a frequent fingerprint; ``BITS / 8`` bytes come to the driver, however many there are."""
    cell = F.col("fp").cast("bigint").bitwiseAND(F.lit(BITS - 1)) + 1
    cells = frequent.select(F.bitmap_bucket_number(cell).alias("bucket"), F.bitmap_bit_position(cell).alias("bit"))
    out = np.zeros(BITS // 8, np.uint8)
    for bucket, bits in cells.groupBy("bucket").agg(F.bitmap_construct_agg("bit")).toLocalIterator():
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bytes(bits), np.uint8)
    return out.tobytes()


HASHED = "lang string, n bigint, hashes binary"


def hashed(texts: DataFrame) -> DataFrame:
    """The word hashes of the texts, a row for each language of a slice, in a compressed scratch table."""

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        cut = Cutter()
        for rows in slices:
            parts = [(lang, int((h != 0).sum()), h.tobytes()) for lang, _, _, h, _, _ in cut(rows)]
            yield dict(zip(("lang", "n", "hashes"), zip(*parts, strict=True), strict=True)) if parts else {"lang": [], "n": [], "hashes": []}

    path = work_dir(texts.sparkSession, "hashed")
    map_slices(texts.select("lang", "text"), HASHED, run, SLICE).write.options(compression="zstd", **ROW_GROUPS).parquet(path)
    return texts.sparkSession.read.schema(HASHED).parquet(path)


def frequent_prints(words: DataFrame, length: int, shorter: bytes | None, least: int) -> bytes:
    """The bitmap of the fingerprints of ``length`` words that occur ``least`` times, by that of those a word shorter."""
    sent = words.sparkSession.sparkContext.broadcast(shorter)
    schema = pa.schema([("fp", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Prints()
        likely = Bitmap(sent.value) if sent.value else None
        held: list[np.ndarray] = []

        def send() -> Iterator[pa.RecordBatch]:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            for at in range(0, len(found), SENT):  # the executor holds a batch as a whole
                rows = found[at : at + SENT].view(np.int32), n[at : at + SENT].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows], schema=schema)

        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("hashes"), strict=True):
                hashes = np.frombuffer(raw.as_buffer(), np.uint64)
                found, whole = prints(hashes, lang, length)
                if likely and len(found):
                    part = likely(prints(hashes, lang, length - 1)[0])
                    whole &= part[:-1] & part[1:]
                held.append(found[whole].astype(np.uint32))
                if sum(map(len, held)) > HELD:
                    yield from send()
        if held:
            yield from send()

    rows = bounded_batches(words.select("lang", "hashes")).mapInArrow(run, "fp int, n bigint")
    counts = rows.groupBy("fp").agg(F.sum("n").alias("n"))
    out = bitmap(counts.where(F.col("n") >= least))
    sent.unpersist()
    return out


def counted(held: list[bytes], serial: np.ndarray, prints: np.ndarray, places: np.ndarray, length: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The phrases at ``places`` with their counts, and the place of one occurrence of each.

    A fingerprint's phrase is the one at its first place. Places with other words, compared by the words' serial
    numbers, count by their own words.
    """
    _, first, back, n = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
    pointer = places[first]
    odd = np.zeros(len(places), bool)
    for j in range(length):
        odd |= serial[places + j] != serial[pointer[back] + j]
    n = n - np.bincount(back[odd], minlength=len(n))
    phrases = [b" ".join(held[p : p + length]) for p in pointer.tolist()]
    if odd.any():
        strays = places[odd].tolist()
        others = Counter(b" ".join(held[p : p + length]) for p in strays)
        where = {b" ".join(held[p : p + length]): p for p in strays}
        phrases += list(others)
        n = np.concatenate([n, list(others.values())])
        pointer = np.concatenate([pointer, [where[w] for w in others]])
    return phrases, n.astype(np.int64), pointer.astype(np.int64)


COUNTED = "lang string, words int, phrase binary, n bigint, doc_id bigint"


def verified(texts: DataFrame, likely: list[bytes], least: int) -> DataFrame:
    """Phrases that occur ``least`` times: ``lang``, ``words`` (how many), ``phrase``, ``n`` and ``doc_id`` of an occurrence."""
    sent = texts.sparkSession.sparkContext.broadcast(likely)

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        cut, prints, maps = Cutter(), Prints(), [Bitmap(b) for b in sent.value]
        for rows in slices:
            for lang, held, serial, hashes, starts, at in cut(rows):
                for length, frequent in enumerate(maps, 1):
                    found, whole = prints(hashes, lang, length)
                    places = np.flatnonzero(whole)
                    places = places[frequent(found[places])]
                    if not len(places):
                        continue
                    phrases, n, where = counted(held, serial, found[places], places, length)
                    doc = np.searchsorted(starts, where, "right") - 1
                    yield {
                        "lang": [lang] * len(phrases),
                        "words": np.full(len(phrases), length, np.int32),
                        "phrase": phrases,
                        "n": n,
                        "doc_id": [rows["doc_id"][at[d]] for d in doc.tolist()],
                    }

    rows = map_slices(texts.select("doc_id", "lang", "text"), COUNTED, run, SLICE)
    counts = rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id")).where(F.col("n") >= least)
    return counts.withColumn("phrase", F.col("phrase").cast("string"))


def wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more with ``l``, ``r`` and ``score`` of the cut that scores lowest, the first of equal ones."""
    words = F.split("phrase", " ")
    longer = phrases.where("words > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    part = lambda start, count: F.array_join(F.slice(words, start, count), " ")
    cuts = longer.withColumns({"left": part(F.lit(1), F.col("cut")), "right": part(F.col("cut") + 1, F.col("words") - F.col("cut"))})
    side = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr("(cast(n AS decimal(20,0)) * 2000000BD) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))"))
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("lowest")
    return cuts.groupBy("lang", "words", "phrase", F.col("n").alias("a"), "doc_id").agg(lowest).select("lang", "words", "phrase", "a", "doc_id", "lowest.*")


def within(phrases: DataFrame) -> DataFrame:
    """For each phrase of two words or more that lies in longer ones: ``held``, the count of the most frequent of these."""
    words = F.split("phrase", " ")
    sizes = phrases.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    parts = sizes.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = F.array_join(F.slice(words, F.col("start"), F.col("size")), " ")
    return parts.groupBy("lang", inner.alias("phrase")).agg(F.max("n").alias("held"))


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, best: int = BEST) -> DataFrame:
    """The ``best`` collocations of each language in ``docs`` (``doc_id``, ``text``, ``lang``).

    Texts, lower-cased in A-Z, are cut into pieces at ``. , ; : ! ?`` and line ends, and these into words at blanks and
    tabs. Phrases of 2 to 4 words that occur ``least`` times within pieces are scored by their worst cut; a phrase that lies in a
    longer one of ``share`` % of its count or more is left out. Returns ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``
    (counts of the phrase and of the parts of its cut), ``n`` (words of the language), ``score`` and ``doc_id``, a
    document that holds the phrase (null where that has no id).

    Null and empty texts have no words; a null language is ``und``, and so joins rows that say so. Rows that repeat an
    id or a text are documents of their own and count each time. Texts are taken whole, whatever their length. Ties go
    by count, then by the phrase's bytes. An empty table gives no rows; other columns are ignored.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), lang.alias("lang"), "text")
    words = hashed(texts)
    likely: list[bytes] = []
    for length in range(1, LONGEST + 1):
        likely.append(frequent_prints(words, length, likely[-1] if likely else None, least))
    phrases = stored(verified(texts, likely, least), "phrases")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    kept = scored(phrases).join(within(phrases), ["lang", "phrase"], "left")
    kept = kept.where(F.coalesce(wide("held") * 100 < wide("a") * share, F.lit(True)))
    order = F.desc("score"), F.desc("a"), F.col("phrase")
    dealt = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))  # so that no task sorts a whole language
    near = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= best)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    ranked = ranked.join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score", "doc_id")


ORACLE = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
  lines AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
  grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM lines, range(1, 5) AS ks(k) WHERE len(w) >= k),
  f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
  totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lines GROUP BY lang),
  candidates AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
  halves AS MATERIALIZED (
    SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
    FROM candidates, range(1, 4) AS ks(cut) WHERE cut < k),
  cuts AS (
    SELECT h.*, x.a AS l, y.a AS r, 2000000::HUGEINT * h.a // (x.a + y.a) AS score
    FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.first JOIN f y ON y.lang = h.lang AND y.phrase = h.rest),
  lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
  parts AS MATERIALIZED (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS held
    FROM candidates, range(2, 4) AS ks(size), range(1, 4) AS places(i) WHERE size < k AND i + size - 1 <= k GROUP BY ALL),
  kept AS (
    SELECT c.* FROM lowest c LEFT JOIN parts p ON p.lang = c.lang AND p.phrase = c.phrase
    WHERE held IS NULL OR 100 * held::HUGEINT < 80 * c.a::HUGEINT),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
