"""Removal of repeated passages by suffix arrays.

Every string of ``window`` bytes that also starts earlier (smaller doc_id, or same document and earlier start) marks
the bytes it covers. The work is cut so that equal strings always meet in one bounded task:

1. Each string of ``window`` bytes is filed under the smallest hash of the k-mers inside it. Neighbouring strings under
   one hash make a unit (at most ``window - k + 1`` strings), some three units per hundred bytes of text. Equal
   strings have equal hashes, so they lie in units of one hash. A task merges units of equal content in its own batch
   and keeps the places of the later ones with the first.
2. Hashes met once are dropped, unless the unit may repeat itself (its smallest k-mer lies in it twice): a first pass counts
   hashes alone, with partial sums a block. Units with equal content are merged by a grouped minimum: all but the first are marked whole.
3. Hashes with several contents, or one that may repeat itself, go, in groups of bounded size, to a suffix array each: two-stage sorting (only
   suffixes smaller than their successor are compared, the others are induced by scanning the buckets) of the suffixes that
   start a string inside their unit, then common prefixes of adjacent suffixes show the equal strings. A hash with more contents than fit one array has its strings
   aggregated by their own 128-bit hash, with partial sums, so that no key is held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import RollingHash, give_back, prepare, stored, text_blocks

KMER = 32
GROUP_BYTES = 1 << 20  # text in one suffix array
CROWDED = 8192  # contents under one hash beyond which its strings are aggregated instead

COUNT = "h long, c long, loops boolean"
UNIT = "h long, s long, doc_id long, version long, at long, n int, loops boolean, others array<long>"


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[:len(out) - step], out[step:])
        done += step
    return out


def _block_units(texts: list[bytes], window: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Units of texts of at least ``window`` bytes each: hash, text number, start, number of strings, whether it may repeat itself,
    and the rolling hash of all."""
    span = window - kmer + 1
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    rolled = RollingHash(data)
    key = rolled.every(kmer)
    least = _sliding(key, span, np.minimum)  # one per window
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bounds))[:len(least)]
    valid = np.ones(len(least), dtype=bool)
    for end in bounds[1:-1]:
        valid[max(0, end - window + 1):end] = False
    fresh = np.ones(len(least), dtype=bool)
    fresh[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    fresh &= valid
    # runs of windows under one hash, cut to at most `span` windows
    starts = np.flatnonzero(fresh)
    lasts = bounds[owner[starts] + 1] - window + 1
    stops = lasts.copy()
    stops[:-1] = np.minimum(starts[1:], lasts[:-1])
    pieces = -(-(stops - starts) // span)
    if (pieces > 1).any():
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        ends = np.repeat(stops, pieces)
        starts = np.repeat(starts, pieces) + step * span
        stops = np.minimum(starts + span, ends)
    names, owner = least[starts], owner[starts]
    # places of k-mers that are the smallest of some window; equal neighbours show that a unit may repeat itself
    least[~valid] = 0
    most = np.zeros(len(key) + span - 1, dtype=np.uint64)
    most[span - 1:span - 1 + len(least)] = least
    del least, fresh, valid
    anchor = np.flatnonzero(_sliding(most, span, np.maximum) == key)
    again = np.zeros(len(anchor) + 1, dtype=np.int64)
    np.cumsum(key[anchor[1:]] == key[anchor[:-1]], out=again[1:len(anchor)])
    low, high = np.searchsorted(anchor, starts), np.searchsorted(anchor, stops + span - 2, side="right")
    loops = (high - low > 1) & (again[np.maximum(high - 1, 0)] > again[np.minimum(low, len(anchor))])
    return names, owner, starts, stops - starts, loops, bounds, rolled


def _long_texts(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Ids, versions and bytes of texts that hold a string of ``window`` bytes, in blocks of bounded size and in order of both."""
    for part, texts in text_blocks(batches):
        ids, versions = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "version"))
        order = [i for i in np.lexsort((versions, ids)) if len(texts[i]) >= window]
        if order:
            yield ids[order], versions[order], [texts[i] for i in order]


def _hashes(window: int, kmer: int):
    """How often each hash names a unit, and whether one of those may repeat itself; one row a hash and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in _long_texts(batches, window):
            names, _, _, _, loops, _, _ = _block_units(texts, window, kmer)
            known, where = np.unique(names, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(known.view(np.int64)), pa.array(np.bincount(where)), pa.array(np.bincount(where, weights=loops) > 0)], names=["h", "c", "loops"])

    return run


def _units(window: int, kmer: int):
    """Units, those of equal content in one block as one row with the places of the later ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, versions, texts in _long_texts(batches, window):
            h, owner, pos, n, loops, bounds, rolled = _block_units(texts, window, kmer)
            s = rolled.of(pos, pos + n + window - 1)
            pos = pos - bounds[owner]
            order = np.argsort(s, kind="stable")  # places stay in order
            h, s, owner, pos, n, loops = (x[order] for x in (h, s, owner, pos, n, loops))
            again = np.zeros(len(h), dtype=bool)
            again[1:] = (h[1:] == h[:-1]) & (s[1:] == s[:-1])
            head = np.flatnonzero(~again)
            rest = np.stack([ids[owner[again]], versions[owner[again]], pos[again]], axis=1).ravel()
            offsets = 3 * (np.append(head, len(h)) - np.arange(len(head) + 1))
            yield pa.RecordBatch.from_arrays([
                pa.array(h[head].view(np.int64)), pa.array(s[head].view(np.int64)), pa.array(ids[owner[head]]), pa.array(versions[owner[head]]),
                pa.array(pos[head].astype(np.int64)), pa.array(n[head].astype(np.int32)), pa.array(loops[head]),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(rest.astype(np.int64)))],
                names=["h", "s", "doc_id", "version", "at", "n", "loops", "others"])

    return run


def direct_sort(text: np.ndarray, some: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``some`` in the order of their first ``depth`` bytes. Equal beginnings are merged first, by a hash of them."""
    if not len(some):
        return some
    padded = np.zeros(len(text) + depth, dtype=np.uint8)
    padded[:len(text)] = text
    _, first, where = np.unique(RollingHash(padded).of(some, some + depth), return_index=True, return_inverse=True)
    # byte strings of one length, compared inside numpy
    beginnings = np.lib.stride_tricks.sliding_window_view(padded, depth)[some[first]].view(f"S{depth}").ravel()
    rank = np.empty(len(first), dtype=np.int32)
    rank[np.argsort(beginnings)] = np.arange(len(first), dtype=np.int32)
    return some[np.argsort(rank[where], kind="stable")]


def two_stage_sort(data: bytes, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Suffix array of ``data``, right for the first ``depth`` bytes of every suffix.

    Suffixes smaller than their successors are sorted by comparison. One scan over the 256 buckets in ascending order
    places all the others: a suffix larger than its successor comes after it, at the front of the bucket of its first byte.
    With ``wanted``, a flag for each byte, only the suffixes that start at a flagged one are in the array; sorted are these and the
    successors by which they are placed.
    """
    text = np.frombuffer(data, dtype=np.uint8)
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    # type by the next differing byte; the last run is larger than the empty suffix after it
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = np.zeros(n, dtype=bool)
    run = np.searchsorted(change, np.arange(n))
    inner = run < len(change)
    rises[inner] = text[change[run[inner]] + 1] > text[change[run[inner]]]
    placed = ~rises  # those to be placed by their successors
    small = rises
    if wanted is not None:
        # a suffix is needed if it is wanted, or if only larger ones lie between it and a wanted one before it
        at = np.arange(n)
        wall = np.full(n, -1)
        wall[1:] = np.maximum.accumulate(np.where(rises, at, -1))[:-1]
        needed = np.maximum.accumulate(np.where(wanted, at, -1)) > wall
        placed, small = placed & needed, rises & needed
    direct = direct_sort(text, np.flatnonzero(small), depth)
    limits = np.searchsorted(text[direct], np.arange(257))
    fronts: list[list[np.ndarray]] = [[] for _ in range(256)]
    if placed[n - 1]:
        fronts[text[n - 1]].append(np.array([n - 1]))
    out = []
    for byte in range(256):
        own = fronts[byte]
        queue = np.concatenate(own) if own else np.zeros(0, dtype=np.int64)
        parts = [queue]
        while len(queue):  # runs of this byte lead further into its own bucket
            before = queue[queue > 0] - 1
            queue = before[(text[before] == byte) & placed[before]]
            parts.append(queue)
        parts.append(direct[limits[byte]:limits[byte + 1]])
        bucket = np.concatenate(parts)
        if len(bucket):
            out.append(bucket)
            before = bucket[bucket > 0] - 1
            before = before[(text[before] > byte) & placed[before]]
            if len(before):
                first = text[before]
                order = np.argsort(first, kind="stable")
                first, before = first[order], before[order]
                cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
                for group in np.split(before, cuts):
                    fronts[text[group[0]]].append(group)
    order = np.concatenate(out) if out else np.zeros(0, dtype=np.int64)
    return order if wanted is None else order[wanted[order]]


def common_prefixes(data: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix, up to ``most``, of each suffix in ``order`` and the one before it (0 for the first)."""
    text = np.zeros(len(data) + most + 8, dtype=np.uint8)
    text[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, 8)).view("<u8").ravel()  # the eight bytes from every place
    out = np.zeros(len(order), dtype=np.int32)
    left, right, live = order[:-1], order[1:], np.arange(1, len(order))
    room = len(data) - np.maximum(left, right)
    for done in range(0, most, 8):
        differ = words[left + done] ^ words[right + done]
        ended = differ != 0
        lowest = differ[ended]
        lowest &= np.uint64(0) - lowest
        out[live[ended]] = done + (np.frexp(lowest.astype(np.float64))[1] - 1) // 8  # the first byte that differs
        whole = ~ended
        left, right, live = left[whole], right[whole], live[whole]
        if not len(live):
            break
    out[live] = most
    out[1:] = np.minimum(np.minimum(out[1:], most), room)
    return out


def _later(window: int):
    """For one group of unit contents: runs of strings that start earlier in another unit or place.

    A group holds whole hashes, some of them large, so it may be larger than intended: it is searched in parts of about ``GROUP_BYTES``.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("h")
        h = table.column("h").to_numpy()
        ends = np.flatnonzero(np.append(h[1:] != h[:-1], True)) + 1  # of each hash's rows
        held = np.cumsum(pa.compute.binary_length(table.column("seg")).to_numpy())[ends - 1]
        last = np.append(np.flatnonzero(np.diff(held // GROUP_BYTES)), len(ends) - 1)
        stops = ends[last].tolist()
        out = pa.concat_tables([part(table.slice(a, b - a)) for a, b in zip([0, *stops], stops, strict=False)])
        give_back()
        return out

    def part(table: pa.Table) -> pa.Table:
        segments = table.column("seg").to_pylist()
        docs, versions, ats = (table.column(c).to_numpy() for c in ("doc_id", "version", "at"))
        data = b"\0".join(segments)
        sizes = np.array([len(s) for s in segments])
        begin = np.cumsum(sizes + 1) - sizes - 1
        of = np.repeat(np.arange(len(sizes)), sizes + 1)[:len(data)]
        order = two_stage_sort(data, window + 4, np.arange(len(data)) - begin[of] + window <= sizes[of])  # strings inside one unit
        group = np.cumsum(common_prefixes(data, order, window) < window)
        unit = of[order]
        start = ats[unit] + order - begin[unit]
        # only strings that are met more than once
        size = np.bincount(group) if len(group) else np.zeros(0, dtype=np.int64)
        several = size[group] > 1
        group, unit, start = group[several], unit[several], start[several]
        by = np.lexsort((start, versions[unit], docs[unit], group))
        group, unit, start = group[by], unit[by], start[by]
        later = np.zeros(len(by), dtype=bool)
        later[1:] = group[1:] == group[:-1]
        first = np.maximum.accumulate(np.where(later, 0, np.arange(len(by))))
        doc, version = docs[unit], versions[unit]
        # the same place seen in two units is no copy
        later &= (doc != doc[first]) | (version != version[first]) | (start != start[first])
        return _runs(doc[later], version[later], start[later])

    return run


def _runs(doc: np.ndarray, version: np.ndarray, start: np.ndarray) -> pa.Table:
    by = np.lexsort((start, version, doc))
    doc, version, start = doc[by], version[by], start[by]
    head = np.ones(len(doc), dtype=bool)
    head[1:] = (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(doc)) - 1
    return pa.table({"doc_id": pa.array(doc[first], pa.int64()), "version": pa.array(version[first], pa.int64()),
                     "lo": pa.array(start[first], pa.int64()), "hi": pa.array(start[last] if len(doc) else start[first], pa.int64())})


def _cut_segments(window: int):
    """Texts with the units asked of them -> the bytes of each unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches):
            asked = part.column("asked")
            of = np.repeat(np.arange(len(texts)), pa.compute.list_value_length(asked).to_numpy(zero_copy_only=False))
            units = asked.flatten()
            at, n = units.field("at").to_numpy(), units.field("n").to_numpy()
            segments = [texts[t][a:a + k] for t, a, k in zip(of.tolist(), at.tolist(), (n + window - 1).tolist(), strict=True)]
            ids, versions = (part.column(c).to_numpy(zero_copy_only=False)[of] for c in ("doc_id", "version"))
            yield pa.RecordBatch.from_arrays([units.field("h"), units.field("crowded"), pa.array(ids, pa.int64()), pa.array(versions, pa.int64()),
                                              units.field("at"), pa.array(segments, pa.binary())], names=["h", "crowded", "doc_id", "version", "at", "seg"])

    return run


def _strings(window: int):
    """Units -> a row for each of their strings, named by two 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, versions, ats = (batch.column(c).to_numpy() for c in ("doc_id", "version", "at"))
            for i, seg in enumerate(batch.column("seg").to_pylist()):
                data = np.frombuffer(seg, dtype=np.uint8)
                at = np.arange(len(data) - window + 1)
                names = [RollingHash(data).of(at, at + window), RollingHash(data[::-1] ^ 0x55).of(len(data) - at - window, len(data) - at)]
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in names] + [
                    pa.array(np.full(len(at), docs[i])), pa.array(np.full(len(at), versions[i])), pa.array(at + ats[i])],
                    names=["w1", "w2", "doc_id", "version", "lo"])

    return run


def versioned(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Rows (doc_id, version, text, carry as structs): ``version`` is 0 for ids with one text, else a hash of the row's text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"),
                        (F.struct(*(F.col(c).alias(c) for c in carry)) if carry else F.lit(None).cast("boolean")).alias("carry"))
    several = stored(texts.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("version").alias("low"), F.max("version").alias("high"))
                     .where("low <> high").select(F.col("doc_id").alias("of")), "versions")
    if several.isEmpty():
        return texts.withColumn("version", F.lit(0).cast("long"))
    return (texts.join(several, F.col("doc_id") == F.col("of"), "left")
            .withColumn("version", F.when(F.col("of").isNull(), F.lit(0)).otherwise(F.col("version"))).drop("of"))


def repeated_strings(texts: DataFrame, window: int = 100, kmer: int = KMER, crowded: int = CROWDED) -> DataFrame:
    """Runs (doc_id, version, lo, hi) of starts of the strings of ``window`` bytes that also start earlier; runs may touch or overlap.

    ``texts`` are rows (doc_id, version, text); equal rows stand for one document, and documents are in order of both.
    """
    texts = texts.select("doc_id", "version", "text").where("doc_id IS NOT NULL")
    often = (texts.mapInArrow(_hashes(window, kmer), COUNT).groupBy("h").agg(F.sum("c").alias("c"), F.max("loops").alias("loops"))
             .where("c > 1 OR loops").select("h"))
    # Written once: three steps read it, and a lost executor does not bring the text scan back.
    hits = stored(texts.mapInArrow(_units(window, kmer), UNIT).join(often, "h"), "units")
    run = lambda at: (F.col(at).alias("lo"), (F.col(at) + F.col("n") - 1).alias("hi"))
    firsts = hits.groupBy("h", "s").agg(F.min(F.struct("doc_id", "version", "at", "n")).alias("first"), F.max("loops").alias("loops"))
    whole = (hits.join(firsts, ["h", "s"]).where(F.struct("doc_id", "version", "at") != F.struct("first.doc_id", "first.version", "first.at"))
             .select("doc_id", "version", *run("at")))
    place = F.explode(F.transform(F.sequence(F.lit(0), (F.size("others") / 3 - 1).cast("int")), lambda i: F.struct(
        *(F.col("others")[3 * i + j].alias(c) for j, c in enumerate(("doc_id", "version", "at"))))))
    merged = (hits.where("size(others) > 0").select(place.alias("p"), "n", "doc_id", "version", "at")
              .where(F.col("p") != F.struct("doc_id", "version", "at")).select("p.*", "n").select("doc_id", "version", *run("at")))
    firsts = stored(firsts, "contents")
    several = firsts.groupBy("h").agg(F.count("*").alias("contents"), F.max("loops").alias("loops")).where("contents > 1 OR loops").drop("loops")
    asked = (firsts.join(several, "h").select("first.doc_id", "first.version", F.struct(
        "h", F.col("first.at").alias("at"), F.col("first.n").alias("n"), (F.col("contents") > crowded).alias("crowded")).alias("unit"))
        .groupBy("doc_id", "version").agg(F.collect_list("unit").alias("asked")))
    segments = stored(texts.join(asked, ["doc_id", "version"]).mapInArrow(
        _cut_segments(window), "h long, crowded boolean, doc_id long, version long, at long, seg binary"), "segments")
    size = segments.agg(F.coalesce(F.sum(F.length("seg")), F.lit(0))).first()[0]
    groups = int(size // GROUP_BYTES) + 1
    partial = (segments.where("NOT crowded").withColumn("g", F.pmod(F.xxhash64("h"), F.lit(groups)))
               .groupBy("g").applyInArrow(_drop_key(_later(window)), "doc_id long, version long, lo long, hi long"))
    strings = segments.where("crowded").select("doc_id", "version", "at", "seg").mapInArrow(
        _strings(window), "w1 long, w2 long, doc_id long, version long, lo long")
    known = strings.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "version", "lo")).alias("first"), F.count("*").alias("c")).where("c > 1")
    packed = (strings.join(known, ["w1", "w2"]).where(F.struct("doc_id", "version", "lo") != F.col("first"))
              .select("doc_id", "version", "lo", F.col("lo").alias("hi")))
    return whole.unionByName(merged).unionByName(partial).unionByName(packed)


def _drop_key(f):
    return lambda table: f(table.drop_columns(["g"]))


def _cleaned(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches):
            rows = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
            for text, runs in zip(texts, part.column("runs").to_pylist(), strict=True):
                spans: list[list[int]] = []
                for lo, hi in sorted((r["lo"], r["hi"] + window) for r in runs or ()):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], hi)
                    else:
                        spans.append([lo, hi])
                kept, at = [], 0
                for lo, hi in spans:
                    kept.append(text[at:lo])
                    at = hi
                kept.append(text[at:])
                left = b"".join(kept)
                rows["n_bytes"].append(len(text))
                rows["n_removed"].append(len(text) - len(left))
                rows["n_spans"].append(len(spans))
                rows["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                # a cut may split a character; what is left of it goes too
                rows["kept_text"].append(left.decode("utf-8", "ignore"))
            types = {"kept_sha256": pa.string(), "kept_text": pa.string()}
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(v, types.get(k, pa.int64())) for k, v in rows.items()), part.column("carry")],
                                             names=["doc_id", *rows, "carry"])

    return run


def suffix_dedup(docs: DataFrame, window: int = 100, with_text: bool = True, crowded: int = CROWDED,
                 carry: list[str] | None = None) -> DataFrame:
    """Each document without the bytes of strings of ``window`` bytes that also start earlier.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept_text (characters split by a cut are
    left out of it) and the columns in ``carry``, which may not bear one of these names. Null text counts as empty; a text is judged whole,
    however long. Rows with a null doc_id come back whole: without an id there is no order. Equal rows stand for one document, so a
    repeated row is not a copy of itself; texts that share an id are documents of their own, in the order of a hash of the text. Each row gets a
    result. Other columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    carry = carry or []
    named = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if with_text else [])]
    if clash := sorted({c.lower() for c in carry} & {*named, "kept_text"}):
        raise ValueError(f"carried columns bear names of the result: {clash}")
    texts = versioned(docs, carry)
    runs = (repeated_strings(texts, window, crowded=crowded).groupBy(F.col("doc_id").alias("of"), F.col("version").alias("at"))
            .agg(F.collect_set(F.struct("lo", "hi")).alias("runs")))
    kind = texts.schema["carry"].dataType.simpleString()
    cleaned = (texts.join(runs, (F.col("doc_id") == F.col("of")) & (F.col("version") == F.col("at")), "left").select("doc_id", "text", "runs", "carry")
               .mapInArrow(_cleaned(window), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, carry {kind}"))
    return cleaned.select(*named, *(F.col("carry")[c].alias(c) for c in carry))
