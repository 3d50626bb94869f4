"""Cross-entropy difference of two matched n-gram models.

Target and background model share one vocabulary (all words of both), the same order and the same smoothing; they differ in the
texts counted. A document's score is the mean over its tokens of the difference of the two losses: below 0 it reads more like the target.

Words and bigrams are counted under 64-bit keys. How often a word is a history is its count less that of the texts it ends, so histories need no
keys of their own. A task reads its texts in chunks and files the sorted keys and the counts of both models under buckets of keys, so a common
n-gram is one entry a chunk, and a text of both models is read once. A bucket's task adds up its entries and answers every chunk with
what the others count; a chunk adds its own and is scored. Most n-grams are met in one chunk only, so most answers are zeros, which take no
room. Nothing but sums reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import BASE, mixed, prepare, stored, stored_by, text_blocks
from beaconry.operators.tiles import cores_of

SMOOTHING = 0.5
WEIGHT = 0.7  # of the bigram against the unigram
CHUNK = 3 << 20  # bytes of text counted at once
BUCKET = 8 << 20  # bytes of text whose n-grams make a bucket
FILED = 16 << 20  # bytes of text whose chunks are filed together
LEAST_BITS = 6  # of the number of buckets
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
OTHER = ""  # stands for all words left out; no word is empty
# what a key counts, in its last bit
PAIR, WORD = np.uint64(0), np.uint64(1)
KIND = np.uint64(1)


def _words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for part in batches:
        for text in part.column("text").to_pylist():
            counts.update(_words(text))
        if len(counts) > 300_000:
            yield batch()
    yield batch()


def vocabulary_of(texts: DataFrame, most: int) -> list[str]:
    """The ``most`` most frequent words, ties in order of code points; a list of bounded length."""
    counts = texts.select("text").mapInArrow(_unigrams, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(most).collect()]


def _hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


START = _hash(" ")  # no word either


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


COUNTS = ["target", "background", "target_ends", "background_ends"]


class Grams:
    """The n-grams of some texts: sorted ``keys``, for every token the places of its pair, word and the word before (-1: a start), and the
    ``counts`` of both models: n-grams, and texts that end in a word. ``models`` says which texts count for the target and the background."""

    def __init__(self, texts: Iterable[list[str]], models: list[np.ndarray] | None = None):
        numbers = _Numbers()
        ids = [np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)) for words in texts]
        self.sizes = np.array([len(x) for x in ids], dtype=np.int64)
        now = np.concatenate([np.zeros(0, dtype=np.int64), *ids])
        start, before = len(numbers), np.roll(now, 1)
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = start
        hashes = np.array([*map(_hash, numbers), START], dtype=np.uint64)
        pairs, pair = np.unique(before * (start + 1) + now, return_inverse=True)
        keys = np.concatenate([mixed(hashes[pairs // (start + 1)] * np.uint64(BASE) + hashes[pairs % (start + 1)]) & ~KIND | PAIR,
                               hashes[:start] & ~KIND | WORD])
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(keys) + 1, dtype=np.int64)
        place[order], place[-1] = np.arange(len(keys)), -1
        self.keys = keys[order]
        self.pair, self.word, self.history = place[pair], place[len(pairs) + now], place[len(pairs) + before]
        self.counts = {}
        row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        last = self.word[(np.cumsum(self.sizes) - 1)[self.sizes > 0]] if len(row) else np.zeros(0, dtype=np.int64)
        for name, of in zip(("target", "background"), models or (), strict=False):
            weight = of.astype(np.int64)
            for places, w, to in ((np.r_[self.pair, self.word], np.r_[weight[row], weight[row]], name), (last, weight[self.sizes > 0], f"{name}_ends")):
                self.counts[to] = np.bincount(places, weights=w, minlength=len(keys)).astype(np.uint64)


def _packed(x: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the greatest needs, all last bytes first; zeros take none."""
    width = -(-int(x.max(initial=0)).bit_length() // 8)
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((size, 8), dtype=np.uint8)
    if data:
        out[:, :len(data) // size] = np.frombuffer(data, dtype=np.uint8).reshape(-1, size).T
    return out.view("<u8").ravel()


def _reader(vocabulary: frozenset[str] | None):
    if vocabulary is None:
        return _words
    return lambda text: [w if w in vocabulary else OTHER for w in _words(text)]


CHUNKS = "chunk long, ids array<long>, data binary"
PIECES = "chunk long, bucket long, n long, keys binary, " + ", ".join(f"{c} binary" for c in COUNTS)


def _chunks(size: int):
    """Rows of a chunk number, the ids in the chunk, and its rows, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, parts = TaskContext.get().partitionId() << 32, 0, []

        def chunk() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(pa.Table.from_batches(parts))
            ids = [i for part in parts for i in part.column("doc_id").to_pylist() if i is not None]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                                               pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "ids", "data"])

        for part, texts in text_blocks(batches):
            parts.append(part)
            held += sum(map(len, texts)) + 64 * len(texts)
            if held >= size:
                yield chunk()
                number, held, parts = number + 1, 0, []
        if parts:
            yield chunk()

    return run


def _read(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_all()


def _models(texts: pa.Table, chunk: int | None, wanted: list[int] | None) -> list[np.ndarray]:
    """Which texts of a chunk the target and the background count; a chunk without a number is of the target only."""
    if chunk is None:
        return [np.ones(texts.num_rows, dtype=bool), np.zeros(texts.num_rows, dtype=bool)]
    ids = pa.compute.is_in(texts.column("doc_id"), value_set=pa.array(wanted or [], pa.int64())).to_numpy(zero_copy_only=False)
    return [ids, np.ones(texts.num_rows, dtype=bool)]


def _pieces(bits: int, read):
    """For every chunk and bucket the sorted keys that the chunk has there, each less the one before, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data, wanted in zip(batch.column("chunk").to_pylist(), batch.column("data"), batch.column("wanted").to_pylist(), strict=True):
                texts = _read(data.as_buffer())
                grams = Grams(map(read, texts.column("text").to_pylist()), _models(texts, number, wanted))
                if not len(grams.pair):
                    continue
                met, starts = np.unique(grams.keys >> np.uint64(64 - bits), return_index=True)
                some = [slice(a, b) for a, b in zip(starts, [*starts[1:], len(grams.keys)], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([number] * len(some), pa.int64()), pa.array(met.astype(np.int64)), pa.array([s.stop - s.start for s in some], pa.int64()),
                    pa.array([_packed(np.diff(grams.keys[s], prepend=np.uint64(0))) for s in some], pa.binary()),
                    *(pa.array([_packed(grams.counts[c][s]) for s in some], pa.binary()) for c in COUNTS)],
                    names=["chunk", "bucket", "n", "keys", *COUNTS])

    return run


SUMS = ["n_words", "target_tokens", "background_tokens", "target_texts", "background_texts"]
ANSWERS = ("chunk long, bucket long, n long, " + ", ".join(f"{c} binary" for c in COUNTS) + ", " + ", ".join(f"{c} long" for c in SUMS))


def _answers(table: pa.Table) -> pa.Table:
    """For every chunk that has n-grams in one bucket what the others count of them, and a row with the bucket's sums."""
    chunks, sizes = table.column("chunk").to_pylist(), table.column("n").to_pylist()
    parts = [np.cumsum(_unpacked(x, n), dtype=np.uint64) for x, n in zip(table.column("keys").to_pylist(), sizes, strict=True)]
    keys, where = np.unique(np.concatenate(parts), return_inverse=True)
    del parts
    is_word = keys & KIND == WORD
    columns: dict[str, list] = {"chunk": [*chunks, None], "bucket": [table.column("bucket")[0].as_py()] * (len(chunks) + 1), "n": [*sizes, None]}
    sums = {"n_words": int(is_word.sum())}
    for name in COUNTS:
        own = np.concatenate([_unpacked(x, n) for x, n in zip(table.column(name).to_pylist(), sizes, strict=True)])
        total = np.bincount(where, weights=own.astype(np.float64), minlength=len(keys)).astype(np.uint64)  # exact below 2^53
        rest = total[where] - own
        ends = np.cumsum([0, *sizes])
        columns[name] = [_packed(rest[a:b]) if chunk is not None else None for chunk, a, b in zip(chunks, ends[:-1], ends[1:], strict=True)] + [None]
        model, _, kind = name.partition("_")
        sums[f"{model}_{'texts' if kind else 'tokens'}"] = int(total[is_word].sum())
    for name in SUMS:
        columns[name] = [None] * len(chunks) + [sums[name]]
    types = {c: pa.binary() for c in COUNTS}
    out = pa.table({c: pa.array(v, types.get(c, pa.int64())) for c, v in columns.items()})
    return out.filter(pa.array([c is not None for c in chunks] + [True]))


SCORED = ["doc_id", "n_tokens", "target_loss", "background_loss", "score", "selected"]


def losses(counts: np.ndarray, ends: np.ndarray, grams: Grams, tokens: int, texts: int, outcomes: int) -> np.ndarray:
    """Negative log probability of each token from the counts of ``grams.keys``: its bigram interpolated with add-``SMOOTHING`` unigrams."""
    unigram = (counts[grams.word] + SMOOTHING) / (tokens + SMOOTHING * outcomes)
    before = np.where(grams.history < 0, texts, (counts - ends)[grams.history])
    bigram = np.divide(counts[grams.pair], before, out=unigram.copy(), where=before > 0)
    return -np.log(WEIGHT * bigram + (1 - WEIGHT) * unigram)


def _scores(read, outcomes: int, sums: dict[str, int]):
    """Scores of one chunk's texts from the answers of its buckets, which follow each other as its sorted keys do."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.bool_())], names=SCORED)
        texts = _read(chunk.column("data")[0].as_buffer())
        models = _models(texts, chunk.column("chunk")[0].as_py(), chunk.column("wanted")[0].as_py())
        grams = Grams(map(read, texts.column("text").to_pylist()), models)
        answers = answers.sort_by("bucket")
        row = np.repeat(np.arange(len(grams.sizes)), grams.sizes)

        def counted(name: str) -> np.ndarray:
            others = [_unpacked(x, n) for x, n in zip(answers.column(name).to_pylist(), answers.column("n").to_pylist(), strict=True)]
            return (np.concatenate([np.zeros(0, dtype=np.uint64), *others]) + grams.counts[name]).astype(np.float64)

        loss = []
        for name in ("target", "background"):
            each = losses(counted(name), counted(f"{name}_ends"), grams, sums[f"{name}_tokens"], sums[f"{name}_texts"], outcomes) if len(row) else np.zeros(0)
            loss.append(np.round(np.bincount(row, weights=each, minlength=len(grams.sizes)) / np.maximum(1, grams.sizes), 9))
        diff = np.round(loss[0] - loss[1], 9)
        return pa.table([texts.column("doc_id"), pa.array(grams.sizes), pa.array(loss[0]), pa.array(loss[1]), pa.array(diff), pa.array(diff < 0)],
                        names=SCORED)

    return run


def cross_entropy_difference(docs: DataFrame, target: DataFrame | None = None, most: int | None = None, target_ids: DataFrame | None = None) -> DataFrame:
    """Per row doc_id, n_tokens, target_loss and background_loss (nats a token), score (their difference) and selected (score < 0).

    The background model counts all of ``docs``; the target model the rows of ``docs`` whose doc_id is in ``target_ids`` and all of ``target`` (a
    column text), whichever is given. Tokens are lower-cased words, all of them in the vocabulary; ``most`` leaves only that many most frequent
    ones, all others being one class. A text without words, null included, has losses and score 0 and is not selected; texts are read whole,
    however long. Rows are scored one by one, repeated ones and such without id too; other columns are ignored. Empty tables give uniform models.

    The ids of the target meet the ids of the chunks, not the texts: what moves is a list of ids. The compressed chunks lie filed by their number.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tables = [texts] + ([] if target is None else [target.select(F.lit(None).cast("long").alias("doc_id"), "text")])
    every = tables[0].select("text") if len(tables) == 1 else tables[0].select("text").unionByName(tables[1].select("text"))
    read = _reader(None if most is None else frozenset(vocabulary_of(every, most)))
    size = every.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = max(LEAST_BITS, (size // BUCKET).bit_length())
    # the chunks are met by key three times and are most of what would move, so they are filed by it
    chunks = stored_by(texts.mapInArrow(_chunks(CHUNK), CHUNKS), "chunks", "chunk", max(2 * cores_of(docs), size // FILED))
    if target_ids is None:
        chunks = chunks.select("chunk", "data", F.lit(None).cast("array<long>").alias("wanted"))
    else:
        ids = target_ids.select(F.col("doc_id").cast("long").alias("id")).where("id IS NOT NULL").distinct()
        met = chunks.select("chunk", F.explode("ids").alias("id")).join(ids, "id", "left_semi")
        wanted = stored(met.groupBy("chunk").agg(F.collect_set("id").alias("wanted")), "wanted")  # at most a chunk's own ids
        chunks = chunks.select("chunk", "data").join(wanted, "chunk", "left")
    counted = chunks
    for more in tables[1:]:  # counted but not scored: its chunks have no number
        other = more.mapInArrow(_chunks(CHUNK), CHUNKS).select(F.lit(None).cast("long").alias("chunk"), "data", F.lit(None).cast("array<long>").alias("wanted"))
        counted = counted.unionByName(other)
    spark.conf.set(BATCH, "4")  # a row is a whole chunk
    try:
        answers = stored(counted.mapInArrow(_pieces(bits, read), PIECES).groupBy("bucket").applyInArrow(_answers, ANSWERS), "counts")
    finally:
        prepare(spark)
    sums = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS)).first().asDict()
    # one more outcome than words, unless the class of others is among them already
    outcomes = sums["n_words"] + 1 if most is None else min(most, sums["n_words"]) + 1
    return (chunks.groupBy("chunk").cogroup(answers.where("chunk IS NOT NULL").select("chunk", "bucket", "n", *COUNTS).groupBy("chunk"))
            .applyInArrow(_scores(read, outcomes, sums), "doc_id long, n_tokens long, target_loss double, background_loss double, score double, selected boolean"))
