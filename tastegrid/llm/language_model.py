"""N-gram language model in Elias-Fano tries, counted and queried by ranges of contexts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.batches import items, map_slices, mix, split_words
from tastegrid.llm.elias_fano import EliasFano, mapped
from tastegrid.llm.exchange import key_bits, map_blocks
from tastegrid.session import ship_package, stored

#: Text per block: larger blocks hold more repeats and so ask less.
BLOCK_BYTES = 6 << 20
#: A word that is this part of a block's words is a candidate for splitting.
HEAVY = 1024
#: A heavy word's successors are dealt out over so many keys.
SALTS = 64
DISCOUNT = 0.75
#: Steps of a stored probability per power of ten; 0 stands for an unseen n-gram.
STEPS = 24
BASE = 0.1
# a blank can't be in a word
END = np.uint64(xxhash.xxh3_64_intdigest(" end"))
START = np.uint64(xxhash.xxh3_64_intdigest(" start"))

_BLOCKS = (
    "ids array<long>, train array<boolean>, n_words array<long>, words binary, codes binary, "
    "heavy array<long>, heavy_n array<long>, train_words long, train_docs long, total long"
)
_ASKED = (
    "bucket int, block long, contexts binary, degrees binary, low binary, high binary, "
    "counts binary"
)
_ANSWERED = (
    "block long, bucket int, context_n binary, context_kinds binary, found binary, known long"
)
_SCORES = (
    "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


@dataclass(frozen=True)
class Split:
    """The heavy words (and the start), whose successors several ranges hold."""

    words: np.ndarray
    counts: np.ndarray

    def keys(self, word: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Range key of each bigram: the word, with a part of the successors if heavy."""
        heavy = np.isin(word, self.words)
        key = mix(word)
        salt = successor[heavy] % np.uint64(SALTS) + np.uint64(1)
        key[heavy] = mix(word[heavy] ^ mix(salt))
        return key

    def all_keys(self) -> np.ndarray:
        """[words, salts]."""
        salts = mix(np.arange(1, SALTS + 1, dtype=np.uint64))
        return mix(self.words[:, None] ^ salts[None])


def _pack(codes: np.ndarray) -> bytes:
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _blocks(docs: DataFrame) -> DataFrame:
    def work(piece: pa.RecordBatch) -> dict:
        starts, words = split_words(piece.column("text"), lower=True)
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(False).astype(np.int64)
        often = np.bincount(codes, minlength=len(coded.dictionary))
        rank = np.argsort(-often, kind="stable")  # frequent words get small codes
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        codes = place[codes]
        hashes = np.fromiter(
            (xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()),
            np.uint64, len(rank),
        )[rank]
        train = pc.fill_null(piece.column("train"), False).to_numpy(False)
        counts = np.diff(starts)
        n_train = np.bincount(codes[np.repeat(train, counts)], minlength=len(rank))
        heavy = np.flatnonzero(n_train * HEAVY >= max(len(codes), 1))
        return {
            "ids": [piece.column("doc_id").to_pylist()], "train": [train], "n_words": [counts],
            "words": [hashes.tobytes()], "codes": [_pack(codes)],
            "heavy": [hashes[heavy].view(np.int64)], "heavy_n": [n_train[heavy]],
            "train_words": [int(n_train.sum())], "train_docs": [int(train.sum())],
            "total": [len(codes) + len(counts)],
        }

    return map_slices(docs, ["doc_id", "train", "text"], work, _BLOCKS, limit=BLOCK_BYTES) \
        .withColumn("block", F.monotonically_increasing_id())


class _Bigrams:
    """A block's different bigrams, by range key and successor."""

    def __init__(self, row: pa.RecordBatch, split: Split):
        words = items(row.column("words"), np.uint64)[0]
        codes = _unpack(row.column("codes")[0].as_py())
        self.n_words = np.array(row.column("n_words")[0].as_py(), np.int64)
        self.train = np.array(row.column("train")[0].as_py(), bool)
        m = len(words)
        self.words = np.concatenate([words, [END, START]])
        sizes = self.n_words + 1
        ends = np.cumsum(sizes)
        first = np.zeros(int(sizes.sum()), bool)
        first[ends - sizes] = True
        last = np.zeros(len(first), bool)
        last[ends - 1] = True
        self.context = np.full(len(first), m + 1)
        self.context[~first] = codes
        self.successor = np.full(len(first), m)
        self.successor[~last] = codes
        pairs, inverse = np.unique(self.context * (m + 1) + self.successor, return_inverse=True)
        context, successor = pairs // (m + 1), pairs % (m + 1)
        keys = split.keys(self.words[context], self.words[successor])
        short = self.words[successor] >> np.uint64(24)
        order = np.lexsort((short, keys))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.of_token = place[inverse]
        seen = np.bincount(inverse, np.repeat(self.train, sizes), len(pairs)).astype(np.uint32)
        self.keys, self.short, self.counts = keys[order], short[order], seen[order]
        asked = split.all_keys()[np.isin(split.words, self.words[np.unique(context)])]
        self.contexts = np.unique(np.concatenate([self.keys, asked.ravel()]))


def _ask(blocks: DataFrame, split: Split, bits: int) -> DataFrame:
    """Each block's bigrams with their training counts, a row per range of contexts."""
    def work(row: pa.RecordBatch) -> dict:
        b = _Bigrams(row, split)
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64((64 - bits) % 64)
        cut = np.append(np.searchsorted(b.contexts, edges), len(b.contexts))
        some = np.flatnonzero(np.diff(cut))
        first = np.append(np.searchsorted(b.keys, b.contexts), len(b.keys))
        degrees = np.diff(first).astype(np.uint32)
        at = first[cut]
        low, high = b.short.astype(np.uint32), (b.short >> np.uint64(32)).astype(np.uint8)
        block = row.column("block")[0].as_py()

        def parts(values: np.ndarray, where: np.ndarray) -> pa.Array:
            return pa.array(
                [values[where[i] : where[i + 1]].tobytes() for i in some], pa.binary()
            )

        return {
            "bucket": some, "block": np.full(len(some), block, np.int64),
            "contexts": parts(b.contexts, cut), "degrees": parts(degrees, cut),
            "low": parts(low, at), "high": parts(high, at), "counts": parts(b.counts, at),
        }

    return map_blocks(blocks, work, _ASKED)


class Trie:
    """Contexts, each with its successors in order: monotone pointers into one monotone
    sequence, and a quantised probability per successor.

    ``contexts`` are ascending hashes; a successor's number is relative to its context:
    the sequence holds context * width + successor.
    """

    def __init__(self, contexts: int, width: int, pairs: np.ndarray, steps: np.ndarray):
        self.width = width
        degrees = np.bincount((pairs // width).astype(np.int64), minlength=contexts)
        self.pointers = EliasFano(np.concatenate([[0], np.cumsum(degrees)]), len(pairs) + 1)
        self.successors = EliasFano(pairs, contexts * width)
        self.steps = mapped(steps)

    def look_up(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Quantised probability of each successor after its context, 0 if unseen."""
        if not len(self.steps):
            return np.zeros(len(context), np.uint8)
        first = self.pointers.at(context).astype(np.int64)
        last = self.pointers.at(context + 1).astype(np.int64)
        wanted = context.astype(np.uint64) * np.uint64(self.width) + successor.astype(np.uint64)
        at = self.successors.find(wanted, first, last)
        return np.where(at >= 0, self.steps[at], 0).astype(np.uint8)


def quantised(probability: np.ndarray) -> np.ndarray:
    steps = np.rint(-np.log10(probability) * STEPS)
    return (1 + np.clip(steps, 0, 254)).astype(np.uint8)


def probability(steps: np.ndarray) -> np.ndarray:
    return np.where(steps > 0, 10.0 ** ((1.0 - steps) / STEPS), 0.0)


def _settle(table: pa.Table, split: Split) -> pa.Table:
    """Counts one range's bigrams, builds its trie and looks up all that was asked."""
    contexts, n_contexts = items(table.column("contexts"), np.uint64)
    degrees, _ = items(table.column("degrees"), np.uint32)
    low, n_entries = items(table.column("low"), np.uint32)
    high, _ = items(table.column("high"), np.uint8)
    counts, _ = items(table.column("counts"), np.uint32)
    short = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
    known, context = np.unique(contexts, return_inverse=True)
    successors, successor = np.unique(short, return_inverse=True)
    width = max(len(successors), 1)
    entry = np.repeat(context, degrees)
    value = entry.astype(np.uint64) * np.uint64(width) + successor.astype(np.uint64)
    trained = np.flatnonzero(counts)
    pairs, at = np.unique(value[trained], return_inverse=True)
    n = np.bincount(at, counts[trained], len(pairs))
    owner = (pairs // np.uint64(width)).astype(np.int64)
    total = np.bincount(owner, n, len(known))
    kinds = np.bincount(owner, minlength=len(known))
    heavy = split.all_keys().ravel()
    is_heavy = np.isin(known, heavy)
    whole = total.copy()
    if is_heavy.any():
        of = np.argsort(heavy)
        spot = of[np.searchsorted(heavy[of], known[is_heavy])] // SALTS
        whole[is_heavy] = split.counts[spot]
    trie = Trie(len(known), width, pairs, quantised((n - DISCOUNT) / whole[owner]))
    found = trie.look_up(entry, successor)
    ends, entry_ends = np.cumsum(n_contexts), np.cumsum(n_entries)

    def parts(values: np.ndarray, stops: np.ndarray, sizes: np.ndarray) -> pa.Array:
        return pa.array(
            [values[e - s : e].tobytes() for e, s in zip(stops, sizes, strict=True)], pa.binary()
        )

    first = np.zeros(len(table), np.int64)
    first[0] = int(((total > 0) & ~is_heavy).sum())
    return pa.table({
        "block": table.column("block"), "bucket": table.column("bucket"),
        "context_n": parts(total[context].astype(np.uint64), ends, n_contexts),
        "context_kinds": parts(kinds[context].astype(np.uint32), ends, n_contexts),
        "found": parts(found, entry_ends, n_entries), "known": first,
    })


def _heavy(blocks: DataFrame) -> Split:
    """Words that make up a part of 1/HEAVY of some block, with their counts in training,
    and the start. Kept are those of at least half that part of all words, so 2 * HEAVY
    at most."""
    totals = blocks.agg(F.sum("train_words"), F.sum("train_docs")).first()
    least = max(1, (totals[0] or 0) // (2 * HEAVY))
    some = blocks.select(F.explode(F.arrays_zip("heavy", "heavy_n")).alias("h")).groupBy(
        F.col("h.heavy").alias("word")
    ).agg(F.sum("h.heavy_n").alias("n")).where(F.col("n") >= least).select("word")
    wanted = np.array([r.word for r in some.collect()], np.int64).view(np.uint64)

    def work(row: pa.RecordBatch) -> dict:
        words = items(row.column("words"), np.uint64)[0]
        train = np.array(row.column("train")[0].as_py(), bool)
        sizes = np.array(row.column("n_words")[0].as_py(), np.int64)
        codes = _unpack(row.column("codes")[0].as_py())[np.repeat(train, sizes)]
        mine = np.flatnonzero(np.isin(words, wanted))
        n = np.bincount(codes, minlength=len(words))[mine]
        return {"word": words[mine].view(np.int64), "n": n}

    sums = map_blocks(blocks, work, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")
    ).collect() if len(wanted) else []
    words = np.array([r.word for r in sums], np.int64).view(np.uint64)
    counts = np.array([r.n for r in sums], np.int64)
    return Split(np.append(words, START), np.append(counts, totals[1] or 0))


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``
    (doc_id, text, train).

    Tokens are words in lower case (A-Z) between ASCII white space and an end. Counts are
    over the rows where ``train`` holds. ``base_score`` adds log10((c + 0.1) / (N + 0.1 *
    (V + 1))). ``score`` adds log10 of the interpolated bigram probability
    (c12 - D) / c1 + D * T1 / c1 * base, T1 the number of successors seen after the word;
    after a word never seen it is the base.

    Texts are stored once as blocks of word numbers. A block sends its different bigrams
    with their counts, by hash ranges of the first word; the words that are common enough
    to matter are split by successor. One task holds one range at a time: it adds up the
    counts, builds the trie and sends each block the quantised probabilities it asked for.
    Words are told apart by 64 bits, successors of one word by 40.

    A null text is empty and has the end alone. A null ``train`` or doc_id is scored and
    not learnt from. Repeated rows count as often as they occur. Without training rows
    all counts are 0. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    blocks = stored(_blocks(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        (F.col("train") & F.col("doc_id").isNotNull()).alias("train"),
    )), "words")
    split = _heavy(blocks)
    totals = blocks.agg(F.sum("train_words"), F.sum("train_docs"), F.sum("total")).first()
    n_words, n_docs, total = (int(t or 0) for t in totals)
    asked = _ask(blocks, split, key_bits(total))
    answered = stored(
        asked.groupBy("bucket").applyInArrow(lambda t: _settle(t, split), _ANSWERED), "answers"
    )
    n_tokens = n_words + n_docs
    kinds = int(answered.agg(F.sum("known")).first()[0] or 0)
    kinds += int((split.counts[:-1] > 0).sum()) + (n_docs > 0)  # heavy words, and the end
    by_block = answered.groupBy("block").agg(F.sort_array(
        F.collect_list(F.struct("bucket", "context_n", "context_kinds", "found"))
    ).alias("a")).select(
        "block", F.col("a.context_n").alias("context_n"),
        F.col("a.context_kinds").alias("context_kinds"), F.col("a.found").alias("found"),
    )
    work = _scorer(split, n_tokens, kinds, n_docs)
    return map_blocks(blocks.hint("merge").join(by_block, "block"), work, _SCORES)


def _scorer(split: Split, n_tokens: int, kinds: int, n_docs: int):
    def work(row: pa.RecordBatch) -> dict:
        b = _Bigrams(row, split)

        def got(name: str, dtype) -> np.ndarray:
            return items(row.column(name)[0].values, dtype)[0]

        context_n, context_kinds = got("context_n", np.uint64), got("context_kinds", np.uint32)
        steps = got("found", np.uint8)
        count = np.zeros(len(b.words))
        after = np.zeros(len(b.words))
        heavy = np.isin(b.words, split.words)
        light = np.flatnonzero(~heavy[:-2])  # all words but the end and the start
        at = np.searchsorted(b.contexts, mix(b.words[light]))
        count[light], after[light] = context_n[at], context_kinds[at]
        keys = split.all_keys()
        for i in np.flatnonzero(heavy):
            spot = int(np.flatnonzero(split.words == b.words[i])[0])
            count[i] = split.counts[spot]
            after[i] = context_kinds[np.searchsorted(b.contexts, keys[spot])].sum()
        count[-2] = n_docs  # the end
        base = (count + BASE) / (n_tokens + BASE * (kinds + 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            back_off = np.where(count > 0, DISCOUNT * after / count, 1.0)
        own = probability(steps.astype(float))[b.of_token]
        chance = own + back_off[b.context] * base[b.successor]
        sizes = b.n_words + 1
        first = np.cumsum(sizes) - sizes
        return {
            "doc_id": row.column("ids")[0].values, "n_tokens": sizes,
            "n_known": np.add.reduceat((count[b.successor] > 0).astype(np.int64), first),
            "train_tokens": np.full(len(sizes), n_tokens, np.int64),
            "base_score": np.add.reduceat(np.log10(base)[b.successor], first),
            "score": np.add.reduceat(np.log10(chance), first),
        }

    return work

