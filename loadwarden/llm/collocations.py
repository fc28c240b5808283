"""Phrases whose words belong together, mined shard by shard.

A phrase is a run of up to ``longest`` words in a piece of a text; how often it has to
occur in all texts of a language is its support. A shard is a bounded number of words that a
task reads. The parts of a phrase are no rarer than itself, so that the candidates are found in two
rounds: words and pairs of words first, then longer phrases, of which only those are looked
at whose pairs all have the support. In each round a shard counts its phrases, which
leave it as 64-bit digests with their counts, and Spark adds them up: rows grow with the
words of the texts, by at most two a word in the first round, whatever the number of shards.

Then every shard counts the candidates again, exactly and as words. What has the support is known to a
round by a Bloom filter of bounded size, which may let others through, but counts of those are whole as
well, and below the support, like those of digests that are equal by chance. Counts are summed
before the shuffle; nothing is sampled or cut. Scores are worked out with integers of any size.

Cases: A-Z are lowered, and other letters left alone; a null or empty text has no words; a null
language is ``und``, and counts with it where that is a language; repeated rows and null or
equal doc_ids count like any others; no documents give no phrases; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadwarden.llm.rows import arrow_map, pieces, stored

UNKNOWN = "und"
SUPPORT, LONGEST, TOP = 100, 5, 2000
#: Words that are mined together. In smaller shards fewer phrases are met again, and more rows leave.
SHARD_WORDS = 1 << 22
#: Digests that leave a task at once.
BATCH_ROWS = 1 << 17
#: Parts, by digest, in which the phrases of a shard are counted one after the other.
GROUPS = 8
#: Text that a counting task reads at least, where there is enough for all cores, and phrases that it adds up before they leave.
COUNT_BYTES, HELD_PHRASES = 64 << 20, 1 << 19
#: Bits of the filter for each candidate, and how many it has at least and at most.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28
#: Bits that all probes of a candidate fall into.
SLICE = 1 << 16
PROBES = 4

_END = "\n"
_BLANK = pa.scalar(" ", pa.large_string())
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(code: np.ndarray) -> np.ndarray:
    code = (code ^ (code >> np.uint64(32))) * _MIX
    return code ^ (code >> np.uint64(29))


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, a line feed after each piece, and how many there are of each text; some are empty."""
    cut = pc.replace_substring_regex(texts.cast(pa.large_string()).fill_null(""), r"[.,;:!?\n\x0b\x0c\r]+", " \n ")
    cut = pc.ascii_lower(cut)  # wrong on a slice of a longer array, so not before
    cut = pc.replace_substring(pc.binary_join_element_wise(cut, pa.scalar(_END, pa.large_string()), _BLANK), "\t", " ")
    words = pc.split_pattern(cut, " ")
    return words.flatten(), pc.list_value_length(words).to_numpy()


class Shard:
    """Words of some texts as numbers, by language."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.parts: dict[str, list[np.ndarray]] = {}
        self.n = 0

    def add(self, batch: pa.RecordBatch) -> None:
        texts = batch.column("text")
        flat, counts = _tokens(texts)
        coded = flat.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = self.numbers
        known = np.fromiter(
            (-2 if not w else -1 if w == _END else numbers.setdefault(w, len(numbers)) for w in words),
            np.int32,
            len(words),
        )
        tokens = known[coded.indices.to_numpy()]
        langs = batch.column("lang").dictionary_encode()
        names = langs.dictionary.to_pylist()
        of_text = langs.indices.to_numpy()
        of_token = np.repeat(of_text, counts)
        for k, name in enumerate(names):
            mine = tokens if len(names) == 1 else tokens[of_token == k]
            mine = mine[mine != -2]
            self.parts.setdefault(name, []).append(mine)
            self.n += len(mine)

    def by_language(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Each language, its words' numbers with -1 between pieces, and its digests of all words."""
        plain = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.numbers), np.uint64, len(self.numbers))
        for name, parts in self.parts.items():
            tokens = np.concatenate(parts)
            if len(tokens):
                lang = np.uint64(xxhash.xxh3_64_intdigest(name, seed=1))
                yield name, tokens, _mixed(plain ^ lang)


def _levels(tokens: np.ndarray, digests: np.ndarray, longest: int, keep) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(words, counts, first places, digests) of the phrases that ``keep`` keeps, level by level.

    ``keep(words, digests)`` tells which places stay. A phrase of the next level is
    two kept ones that overlap in all words but one.
    """
    numbers, code = tokens, np.zeros(len(tokens), np.uint64)
    places = np.flatnonzero(tokens >= 0).astype(np.int32)
    for k in range(1, longest + 1):
        if k > 1:
            both = (numbers[places] >= 0) & (places + 1 < len(numbers))
            both[both] = numbers[places[both] + 1] >= 0
            places = places[both]
        if not len(places):
            return
        code[places] = _mixed(code[places] * _ODD + digests[tokens[places + k - 1]])
        places = places[keep(k, code[places])]
        phrase, counts, first = _numbered(numbers, places, code, k)
        yield k, counts, first, code[first]
        numbers = np.full(len(tokens), -1, np.int32)
        numbers[places] = phrase


def _numbered(numbers: np.ndarray, places: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """A number for the phrase at each place; of each phrase how often it is there, and its first place."""
    phrase = np.empty(len(places), np.int32)
    counts, firsts, total = [], [], 0
    group = (code[places] >> np.uint64(40)).astype(np.uint32) % GROUPS
    for g in range(GROUPS):
        mine = np.flatnonzero(group == g)
        at = places[mine]
        key = numbers[at].astype(np.int64)
        if k > 1:
            key = (key << 32) | numbers[at + 1]
        own, unique = pd.factorize(key)
        first = np.empty(len(unique), np.int64)
        first[own[::-1]] = at[::-1]
        phrase[mine] = own + total
        counts.append(np.bincount(own, minlength=len(unique)))
        firsts.append(first)
        total += len(unique)
    return phrase, np.concatenate(counts), np.concatenate(firsts)


def _shards(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[Shard]:
    shard = Shard()
    for batch in pieces(batches, 2 << 20):
        if batch.num_rows:
            shard.add(batch)
            if shard.n >= most:
                yield shard
                shard = Shard()
    if shard.n:
        yield shard


def _all_with_support(texts: DataFrame, support: int, shortest: int, longest: int, shard_words: int, known: Filter | None = None) -> DataFrame:
    """``digest`` of all phrases of ``shortest`` to ``longest`` words that have the support.

    Only those are counted whose parts of less than ``shortest`` words are all known to the filter. Digests
    tell languages apart.
    """
    shared = None if known is None else texts.sparkSession.sparkContext.broadcast(known)

    def keep(k: int, digests: np.ndarray) -> np.ndarray:
        return shared.value.has(digests) if k < shortest else np.ones(len(digests), bool)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, shard_words):
            for _, tokens, digests in shard.by_language():
                for k, counts, _, code in _levels(tokens, digests, longest, keep):
                    if k >= shortest:
                        columns = [pa.array(code.view(np.int64)), pa.array(counts)]
                        yield from pa.Table.from_arrays(columns, ["digest", "n"]).to_batches(BATCH_ROWS)

    counted = arrow_map(texts, count, "digest bigint, n bigint")
    return counted.groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") >= support).select("digest")


class Filter:
    """A Bloom filter in slices; all probes of a digest are in one."""

    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.slices = bits // SLICE
        self.data = data

    def slice_of(self, digests: np.ndarray) -> np.ndarray:
        return ((digests >> np.uint64(32)) % np.uint64(self.slices)).astype(np.int64)

    @staticmethod
    def probes(digests: np.ndarray) -> list[np.ndarray]:
        spread = _mixed(digests * _ODD)
        return [(spread >> np.uint64(16 * j) & np.uint64(SLICE - 1)).astype(np.int64) for j in range(PROBES)]

    def has(self, digests: np.ndarray) -> np.ndarray:
        found, begin = np.ones(len(digests), bool), self.slice_of(digests) * SLICE
        for probe in self.probes(digests):
            cell = begin + probe
            found &= (self.data[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
        return found


def filter_of(candidates: DataFrame, bits: int | None = None) -> Filter:
    """The filter of the column ``digest``, made slice by slice; at most 32 MB on the driver."""
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * candidates.count()).bit_length()))
    made = Filter(bits)

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled: dict[int, np.ndarray] = {}
        for batch in batches:
            digests = batch.column("digest").to_numpy().view(np.uint64)
            of_slice = made.slice_of(digests)
            order = np.argsort(of_slice, kind="stable")
            digests, of_slice = digests[order], of_slice[order]
            bounds = np.flatnonzero(np.diff(of_slice, prepend=-1, append=-1))
            for a, b in zip(bounds, bounds[1:]):
                cells = filled.setdefault(int(of_slice[a]), np.zeros(SLICE, bool))
                for probe in Filter.probes(digests[a:b]):
                    cells[probe] = True
        if filled:
            data = [np.packbits(cells).tobytes() for cells in filled.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(filled), pa.int32()), pa.array(data)], ["slice", "data"])

    # The same slice as above, for the shuffle: the upper half of the digest, unsigned.
    of_slice = F.pmod(F.shiftrightunsigned("digest", 32), F.lit(made.slices))
    data = np.zeros((made.slices, SLICE // 8), np.uint8)
    for row in arrow_map(candidates.select("digest").repartition(of_slice), fill, "slice int, data binary").collect():
        data[row["slice"]] = np.frombuffer(row["data"], np.uint8)
    return Filter(bits, data.reshape(-1))


def count_candidates(texts: DataFrame, candidates: Filter, longest: int, shard_words: int) -> DataFrame:
    """(lang, phrase, words, f): how often each candidate, and what else the filter lets through, occurs.

    A row of each language without a phrase, of no words, has the number of all its words.
    """
    shared = texts.sparkSession.sparkContext.broadcast(candidates)
    names = ["lang", "phrase", "words", "f"]

    def summed(parts: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(parts).group_by(names[:3]).aggregate([("f", "sum")])
        return sums.rename_columns([*names]).combine_chunks()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for shard in _shards(batches, shard_words):
            words = pa.array(list(shard.numbers), pa.large_string())
            for lang, tokens, digests in shard.by_language():
                every = [pa.array([v], t) for v, t in zip((lang, None, 0, int((tokens >= 0).sum())), schema.types)]
                held.append(pa.table(every, names).cast(held_schema))
                for k, counts, first, _ in _levels(tokens, digests, longest, lambda _, digests: shared.value.has(digests)):
                    parts = [words.take(pa.array(tokens[first + j])) for j in range(k)]
                    phrase = pc.binary_join_element_wise(*parts, _BLANK) if k > 1 else parts[0]
                    n = len(first)
                    columns = [pa.array([lang] * n, pa.string()), phrase, pa.array([k] * n, pa.int32()), pa.array(counts)]
                    held.append(pa.table(columns, names).cast(held_schema))
            # Shards of a task have most of their phrases in common.
            held = [summed(held)] if held else []
            if held and held[0].num_rows > HELD_PHRASES:
                yield from held.pop().cast(schema).to_batches(1 << 14)
        if held:
            yield from held.pop().cast(schema).to_batches(1 << 14)

    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])
    held_schema = schema.set(1, pa.field("phrase", pa.large_string()))
    found = arrow_map(texts, count, "lang string, phrase string, words int, f bigint")
    return found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))


def frequent_phrases(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shard_words: int = SHARD_WORDS
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases with the support, single words too; and (lang, n), all words."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = docs.select(lang, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    pairs = stored(_all_with_support(texts, support, 1, min(longest, 2), shard_words), "pairs")
    longer = _all_with_support(texts, support, 3, longest, shard_words, filter_of(pairs)) if longest > 2 else pairs.limit(0)
    known = filter_of(stored(pairs.union(longer), "candidates"))
    every = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-every // COUNT_BYTES))
    counted = count_candidates(texts.coalesce(tasks), known, longest, shard_words)
    counted = stored(counted.where((F.col("f") >= support) | (F.col("words") == 0)), "phrases")
    return counted.where("words > 0"), counted.where("words = 0").select("lang", F.col("f").alias("n"))


def _scored(cuts: DataFrame) -> DataFrame:
    """The cuts with ``score``, floor(1000 a n / (l r)), by integers of any size."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = (batch.column(name).to_pylist() for name in ("a", "n", "l", "r"))
            scores = [1000 * a * n // (le * r) for a, n, le, r in zip(*numbers)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.int64())], [*batch.schema.names, "score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cuts.schema)
    return arrow_map(cuts, score, f"{schema}, score bigint")


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    top: int = TOP,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase is cut into two at the place where its score, how much more often it occurs than
    its parts would by chance, is lowest. A phrase that occurs only within a longer one is left out.
    """
    phrases, totals = frequent_phrases(docs, support, longest, shard_words)
    several = phrases.where("words > 1")
    of_words = F.split("phrase", " ", -1)
    cuts = several.select("lang", "phrase", F.col("f").alias("a"), of_words.alias("_w")).select(
        "lang", "phrase", "a", "_w", F.explode(F.sequence(F.lit(1), F.size("_w") - 1)).alias("cut")
    )

    def part(begin, size):
        return F.array_join(F.slice("_w", begin, size), " ")

    cuts = cuts.select(
        "lang", "phrase", "a", "cut",
        part(1, F.col("cut")).alias("_left"),
        part(F.col("cut") + 1, F.size("_w") - F.col("cut")).alias("_right"),
    )
    for side, name in (("_left", "l"), ("_right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    scored = _scored(cuts.join(totals, "lang").select("lang", "phrase", "a", "cut", "l", "r", "n"))
    best = (
        scored.groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("b"))
        .select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")
    )
    # What holds a phrase and is as frequent has a part one word longer than the phrase that is so too.
    inside = (
        phrases.where("words > 2")
        .select("lang", "f", of_words.alias("_w"))
        .select("lang", "f", F.explode(F.array(part(1, F.size("_w") - 1), part(2, F.size("_w") - 1))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("_within"))
    )
    kept = best.join(inside, ["lang", "phrase"], "left").where("_within is null or _within < a").drop("_within")
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
