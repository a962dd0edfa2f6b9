"""Removal of repeated byte strings with a sparse, distributed suffix sort.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere goes.

Not every suffix is sorted. A window of LENGTH bytes has an anchor, the position
of its smallest hashed k-gram; equal windows have their anchors at the same
offset, so only suffixes at anchors are compared. The windows that share an
anchor are neighbours; the text they span is the anchor's context. The steps:

1. k-grams at anchors that occur once anywhere rule out their windows.
2. Of the others, equal contexts (128-bit digests) are repeated as a whole; one
   of them stands for all. Only contexts that occur once are named to their
   documents, as exceptions, when the bytes are removed.
3. Where a k-gram has several contexts, tasks sort the suffixes at the anchors
   and exchange them as front-coded runs: per suffix the length of the prefix it
   shares with the one before it, and the rest. A loser tree merges the runs; a
   suffix carries the prefix it is known to share with the last output, and a
   comparison starts behind it. The merged order's common prefixes tell which
   windows agree from the anchor on; of these, equal hashes of the bytes before
   the anchor tell which agree as a whole.

A k-gram with more than ``GROUP`` contexts is not brought into one task: the
windows of its contexts are counted by 128-bit digests instead, exactly.

Defined cases: null text is empty. Texts shorter than LENGTH lose nothing. A
repeated row is a document of its own, so its windows are repeated. Rows with a
null id take part as any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_features.llm import words as W
from merchant_features.llm.frames import broadcast_fields
from merchant_features.llm.occurrences import Occurrences, count, in_bitmap, slot_bitmap
from merchant_features.sources.storage import materialize

LENGTH = 200
GRAM = 64
GROUP = 20_000
#: Suffixes a task sorts at a time, and contexts that meet in one merge.
RUN_SUFFIXES = 30_000
BUCKET_CONTEXTS = 2_000
KEY_BITS = 26
ID_BITS = 23

C1 = np.uint64(0x9E3779B97F4A7C15)
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


#: Tables made once per process, in a plain dictionary (see ``words._made``).
_made: dict[object, np.ndarray] = {}


def _values() -> np.ndarray:
    if "values" not in _made:
        _made["values"] = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, size=256, dtype=np.uint64)
    return _made["values"]


def _powers(base: int, bits: int) -> np.ndarray:
    """base ** i for i below 2 ** bits, modulo 2 ** 64."""
    if (base, bits) not in _made:
        out = np.full(1 << bits, np.uint64(base))
        out[0] = 1
        _made[base, bits] = np.multiply.accumulate(out)
    return _made[base, bits]


def range_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Two independent 64-bit hashes of raw[begin:end]."""
    bits = max(20, int(len(raw)).bit_length())
    found, values = [], _values()[raw]
    for base in BASES:
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values * _powers(base, bits)[: len(raw)], out=sums[1:])
        back = _powers(pow(base, -1, 1 << 64), bits)
        found.append(W.mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64)))
    return found


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(k-gram hash, anchor, first window, last window + 1) for the windows of a slice, in order.

    ``gram`` is 8 times a power of two.
    """
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    if len(raw) < length:
        return none
    # 8 bytes at every position, then hashes of twice the length from two neighbouring ones
    x = raw.astype(np.uint64)
    for step, shift in ((1, 8), (2, 16), (4, 32)):
        x = x[:-step] | (x[step:] << np.uint64(shift))
    h = x * C1
    h ^= h >> np.uint64(32)
    step = 8
    while step < gram:
        longer = h[:-step] * C1
        longer += h[step:]
        longer ^= longer >> np.uint64(29)
        h, step = longer, 2 * step
    h = W.mix(h)
    m = len(raw) - gram + 1
    # the smallest hash within reach of every window, the leftmost of equal ones
    reach = length - gram + 1
    keyed = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    rows = np.concatenate((keyed, np.full(-m % reach, 2**64 - 1, np.uint64))).reshape(-1, reach)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(raw) - length + 1
    smallest = np.minimum(behind[:windows], ahead[reach - 1 : reach - 1 + windows])
    anchor = (smallest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.repeat(bounds[1:], np.diff(bounds))[:windows]
    inside = np.arange(windows) + length <= ends
    edge = np.ones(windows, bool)
    edge[1:] = anchor[1:] != anchor[:-1]
    edge[bounds[bounds < windows]] = True
    first = np.flatnonzero(inside & edge)
    # a run of windows ends before the next edge, or where its document's windows end
    stop = np.flatnonzero(np.concatenate((edge, [True]))[1:] & inside | (inside & ~np.concatenate((inside[1:], [False])))) + 1
    at = anchor[first]
    # the chosen hashes are the smallest ones: mixed again, they spread over all buckets and bitmap places
    return W.mix(h[at] + C1), at, first, stop


def anchor_hashes(texts: pa.Array, length: int, gram: int) -> Iterator[np.ndarray]:
    for part in W.slices(texts):
        yield anchors(part.raw, part.bounds, length, gram)[0]


def _contexts(part: W.Slice, found: tuple[np.ndarray, ...], chosen: np.ndarray, length: int):
    """(document, k-gram hash, anchor, first, stop, digests) of the chosen anchors."""
    h, at, first, stop = (x[chosen] for x in found)
    one, two = range_hashes(part.raw, first, stop - 1 + length)
    one = W.mix(one + (at - first).astype(np.uint64) * C1 + h)
    document = np.searchsorted(part.bounds, first, side="right") - 1
    digests = np.empty((len(h), 2), np.uint64)
    digests[:, 0], digests[:, 1] = one, two
    return document, h, at, first, stop, digests


def _binary(digests: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(digests).tobytes()
    return pa.array([data[k : k + 16] for k in range(0, len(data), 16)], pa.binary())


def repeated_anchors(texts: DataFrame, occurrences, length: int, gram: int, id_type: str) -> DataFrame:
    """(id, tag, key, context, first, n) of every anchor whose k-gram may occur again; ``first`` counts bytes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "tag", "key", "context", "first", "n"]
        known = Occurrences(*occurrences.value)
        for batch in batches:
            for part in W.slices(batch.column(2)):
                every = anchors(part.raw, part.bounds, length, gram)
                chosen = np.flatnonzero(known.may_repeat(every[0]))
                if not len(chosen):
                    continue
                document, h, _, first, stop, digests = _contexts(part, every, chosen, length)
                rows = pa.array(document + part.rows[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows), pa.array(h.view(np.int64)),
                        _binary(digests), pa.array((first - part.bounds[document]).astype(np.int32)),
                        pa.array((stop - first).astype(np.int32)),
                    ],
                    names,
                )

    return texts.mapInArrow(found, f"id {id_type}, tag bigint, key bigint, context binary, first int, n int")


# --- runs of sorted suffixes ------------------------------------------------------------------------------------------


def common_prefix(x: bytes, y: bytes, known: int) -> int:
    """The length of the prefix that x and y share, of which ``known`` bytes are known."""
    most = min(len(x), len(y))
    while known + 16 <= most and x[known : known + 16] == y[known : known + 16]:
        known += 16
    while known < most and x[known] == y[known]:
        known += 1
    return known


def front_coded(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted suffixes: what each shares with the one before, and the rest."""
    shared, rest, last = [], [], b""
    for suffix in suffixes:
        n = common_prefix(last, suffix, 0)
        shared.append(n)
        rest.append(suffix[n:])
        last = suffix
    return shared, rest


def merged(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, bytes, int]]:
    """(run, place in run, suffix, prefix shared with the suffix before) of front-coded runs, in order.

    A loser tree: a node keeps the run that lost there and how much it shares
    with the winner that passed, which is what it shares with the last output.
    The run that shares more with the last output is smaller; only runs that
    share equally much are compared, from there on.
    """
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    place = [0] * k
    text: list[bytes | None] = [None] * k
    known = [0] * k
    for r, (_, rest) in enumerate(runs):
        text[r] = rest[0] if rest else None
    loser = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes the one shared with the winner."""
        x, y = text[a], text[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = common_prefix(x, y, known[a])
        if x[n:] <= y[n:]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if k > 1 else 0
    while text[winner] is not None:
        out = text[winner]
        yield winner, place[winner], out, known[winner]
        shared, rest = runs[winner]
        place[winner] += 1
        if place[winner] < len(rest):
            n = shared[place[winner]]
            text[winner], known[winner] = out[:n] + rest[place[winner]], n
        else:
            text[winner] = None
        node = (winner + k) // 2
        while node:
            winner, loser[node] = play(winner, loser[node])
            node //= 2


def _suffix_runs(texts: DataFrame, keys, ids, buckets_bits: int, length: int, gram: int) -> DataFrame:
    """(bucket, run): each task's sorted, front-coded anchor suffixes with what stands before the anchors."""

    def run_of(rows: list[tuple]) -> dict:
        rows.sort()
        shared, rest = front_coded([r[0] for r in rows])
        return {
            "shared": shared, "rest": rest, "before": [r[1] for r in rows], "least": [r[2] for r in rows],
            "context": [r[3] for r in rows],
        }

    run_type = pa.struct(
        [("shared", pa.list_(pa.int32())), ("rest", pa.list_(pa.binary())), ("before", pa.list_(pa.binary())),
         ("least", pa.list_(pa.int32())), ("context", pa.list_(pa.binary()))]
    )

    def emitted(buckets: dict[int, list[tuple]]) -> pa.RecordBatch:
        numbers = sorted(buckets)
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array([run_of(buckets[b]) for b in numbers], run_type)], ["bucket", "run"]
        )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: dict[int, list[tuple]] = {}
        seen: set[bytes] = set()
        n = 0
        for batch in batches:
            wanted = in_bitmap(ids.value, batch.column(0).to_numpy())
            for part in W.slices(batch.column(1).filter(pa.array(wanted))):
                every = anchors(part.raw, part.bounds, length, gram)
                slots = (every[0] >> np.uint64(64 - KEY_BITS)).astype(np.int64)
                chosen = np.flatnonzero(in_bitmap(keys.value, slots))
                if not len(chosen):
                    continue
                _, h, at, first, stop, digests = _contexts(part, every, chosen, length)
                raw, data = part.raw.tobytes(), digests.tobytes()
                for k in range(len(chosen)):
                    context = data[16 * k : 16 * k + 16]
                    if context in seen:
                        continue
                    seen.add(context)
                    a, b, e = int(at[k]), int(first[k]), int(stop[k])
                    key = int(h[k])
                    # the hash of the k-gram leads: suffixes of one k-gram stand together
                    suffix = key.to_bytes(8, "big") + raw[a : e - 1 + length]
                    buckets.setdefault(key >> (64 - buckets_bits), []).append((suffix, raw[b:a], a - e + 1, context))
                    n += 1
                    if n >= RUN_SUFFIXES:
                        yield emitted(buckets)
                        buckets, n = {}, 0
        if n:
            yield emitted(buckets)

    slot = F.pmod(F.xxhash64("id", "tag"), F.lit(1 << ID_BITS))
    return texts.select(slot.alias("slot"), "text").mapInArrow(
        found,
        "bucket int, run struct<shared:array<int>,rest:array<binary>,before:array<binary>,least:array<int>,context:array<binary>>",
    )


def repeated_offsets(suffixes: list[bytes], shared: list[int], before: list[bytes], least: list[int], length: int,
                     gram: int) -> np.ndarray:
    """repeated[suffix, offset]: the window that begins ``offset`` bytes before the anchor has an equal.

    ``shared`` is the common prefix with the suffix before, the leading hash of 8 bytes included.
    """
    reach = length - gram + 1
    n = len(suffixes)
    repeated = np.zeros((n, reach), bool)
    most = np.array([len(b) for b in before])
    least_of = np.array(least)
    agreed = np.array(shared) - 8
    agreed[0] = -1
    # hashes of the bytes before the anchor, from the anchor backwards
    back = np.zeros((n, reach - 1), np.uint8)
    for k, b in enumerate(before):
        back[k, : len(b)] = np.frombuffer(b[::-1], np.uint8)
    sums = np.zeros((n, reach), np.uint64)
    np.cumsum(_values()[back] * _powers(BASES[0], 20)[: reach - 1], axis=1, out=sums[:, 1:])
    for offset in range(reach):
        block = np.cumsum(agreed < length - offset)
        own = np.flatnonzero((least_of <= offset) & (offset <= most))
        if len(own) < 2:
            continue
        value = W.mix(W.mix(sums[own, offset]) + block[own].astype(np.uint64) * C1)
        order = np.argsort(value, kind="stable")
        same = np.flatnonzero(value[order][1:] == value[order][:-1])
        repeated[own[order[same]], offset] = True
        repeated[own[order[same + 1]], offset] = True
    return repeated


def _runs_of(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"begin": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]


RUNS = "array<struct<begin:int,end:int>>"


def _merge_buckets(runs: DataFrame, length: int, gram: int) -> DataFrame:
    """(context, windows): the repeated windows of each context, as half-open runs counted from its first."""
    runs_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def resolved(group: pa.Table) -> pa.Table:
        columns = [r.as_py() for r in group.column("run")]
        contexts, windows = [], []
        held: list[tuple] = []

        def flush() -> None:
            if len(held) < 2:
                held.clear()
                return
            flags = repeated_offsets(*[list(x) for x in zip(*[h[:4] for h in held], strict=True)], length, gram)
            for k in np.flatnonzero(flags.any(axis=1)):
                most, least = len(held[k][2]), held[k][3]
                contexts.append(held[k][4])
                # the first window begins farthest before the anchor
                windows.append(_runs_of(flags[k, least : most + 1][::-1]))
            held.clear()

        last = None
        seen: set[bytes] = set()
        cut = 0
        for run, place, suffix, known in merged([(c["shared"], c["rest"]) for c in columns]):
            c = columns[run]
            cut = known if last is None else min(cut, known)
            last = suffix
            if c["context"][place] in seen:  # sent by several tasks
                continue
            if cut < 8 and len(held) >= 4096:  # a new k-gram
                flush()
                seen.clear()
            seen.add(c["context"][place])
            held.append((suffix, cut, c["before"][place], c["least"][place], c["context"][place]))
            cut = 1 << 30
        flush()
        return pa.table({"context": pa.array(contexts, pa.binary()), "windows": pa.array(windows, runs_type)})

    return runs.groupBy("bucket").applyInArrow(resolved, f"context binary, windows {RUNS}")


def _counted_windows(texts: DataFrame, keys: DataFrame, length: int, gram: int) -> DataFrame:
    """(context, windows) for k-grams with too many contexts: their windows are counted by digests."""
    slot = F.shiftrightunsigned("key", 64 - KEY_BITS)
    sent = texts.sparkSession.sparkContext.broadcast(slot_bitmap(keys.select(slot.alias("slot")), KEY_BITS))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in W.slices(batch.column(0)):
                every = anchors(part.raw, part.bounds, length, gram)
                chosen = np.flatnonzero(in_bitmap(sent.value, (every[0] >> np.uint64(64 - KEY_BITS)).astype(np.int64)))
                if not len(chosen):
                    continue
                _, h, _, first, stop, digests = _contexts(part, every, chosen, length)
                data = digests.tobytes()
                new = [k for k in range(len(h)) if data[16 * k : 16 * k + 16] not in seen]
                seen.update(data[16 * k : 16 * k + 16] for k in new)
                if not new:
                    continue
                counts = (stop - first)[new]
                window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                begin = np.repeat(first[new], counts) + window
                pair = np.stack(range_hashes(part.raw, begin, begin + length), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(h[new], counts).view(np.int64)), _binary(np.repeat(digests[new], counts, axis=0)),
                     pa.array(window.astype(np.int32)), _binary(pair)],
                    ["key", "context", "window", "digest"],
                )

    rows = texts.select("text").mapInArrow(windows, "key bigint, context binary, window int, digest binary")
    rows = materialize(rows.join(keys.select("key"), "key", "left_semi").distinct())
    again = rows.groupBy("digest").agg((F.min("context") < F.max("context")).alias("again")).where("again")
    repeated = rows.join(materialize(again.select("digest")), "digest")
    single = F.struct(F.col("window").alias("begin"), (F.col("window") + 1).alias("end"))
    return repeated.select("context", "window").distinct().groupBy("context").agg(
        F.sort_array(F.collect_list(single)).alias("windows")
    )


def _exceptions(texts: DataFrame, occurrences, length: int, gram: int, group: int) -> DataFrame:
    """(id, tag, contexts): the contexts that occur once, per document, each with its windows that are repeated.

    The other contexts of k-grams that may occur again are repeated as a whole, so they need not be named.
    """
    context = texts.sparkSession.sparkContext
    kind = dict(texts.dtypes)["id"]
    contexts = materialize(
        repeated_anchors(texts, occurrences, length, gram, kind).groupBy("key", "context").agg(
            F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("id", "tag", "first", "n")]
        )
    )
    several = materialize(contexts.groupBy("key").count().where("count > 1"))
    shared_keys = several.where(F.col("count") <= group)
    slot = F.shiftrightunsigned("key", 64 - KEY_BITS)
    keys = context.broadcast(slot_bitmap(shared_keys.select(slot.alias("slot")), KEY_BITS))
    holder = F.pmod(F.xxhash64("id", "tag"), F.lit(1 << ID_BITS))
    holders = contexts.join(shared_keys, "key", "left_semi").select(holder.alias("slot"))
    ids = context.broadcast(slot_bitmap(holders, ID_BITS))
    n_contexts = several.agg(F.sum("count")).first()[0] or 0
    buckets_bits = max(6, int(n_contexts / BUCKET_CONTEXTS).bit_length())
    partial = _merge_buckets(_suffix_runs(texts, keys, ids, buckets_bits, length, gram), length, gram)
    crowded = several.where(F.col("count") > group)
    if not crowded.isEmpty():
        partial = partial.unionByName(_counted_windows(texts, crowded, length, gram))
    partial = materialize(partial)
    single = contexts.where("copies = 1").join(partial, "context", "left")
    named = single.select("id", "tag", F.struct("first", "n", "windows").alias("context"))
    return named.groupBy("id", "tag").agg(F.collect_list("context").alias("contexts"))


def _window_flags(part: W.Slice, exceptions: pa.Array, occurrences, length: int, gram: int) -> np.ndarray:
    """For each byte of a slice whether a repeated window begins there."""
    size = len(part.raw)

    def marked(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        depth = np.zeros(size + 1, np.int32)
        np.add.at(depth, begin, 1)
        np.add.at(depth, end, -1)
        return np.cumsum(depth)[:-1] > 0

    key, _, first, stop = anchors(part.raw, part.bounds, length, gram)
    chosen = occurrences.may_repeat(key)
    flags = marked(first[chosen], stop[chosen])
    own = exceptions.slice(part.rows[0], len(part.rows)).fill_null([])
    offsets = np.diff(own.offsets.to_numpy())
    flat = own.flatten()
    if len(flat):
        at = flat.field("first").to_numpy() + np.repeat(part.bounds[:-1], offsets)
        flags &= ~marked(at, at + flat.field("n").to_numpy())
        windows = flat.field("windows").fill_null([])
        runs, of = windows.flatten(), np.repeat(at, np.diff(windows.offsets.to_numpy()))
        if len(runs):
            flags |= marked(of + runs.field("begin").to_numpy(), of + runs.field("end").to_numpy())
    return flags


def _edges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open runs of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                  gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Every row's id, ``n_bytes``, the maximal removed ``spans`` of bytes and the ``kept`` bytes' SHA-256."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", F.xxhash64("text").alias("tag"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = 2 * size / (length - gram + 2)
    occurrences = count(texts, lambda column: anchor_hashes(column, length, gram), expected, most_hot=1)
    sent = broadcast_fields(docs.sparkSession, occurrences)
    exceptions = _exceptions(texts, sent, length, gram, group).withColumnsRenamed({"id": "of", "tag": "of_tag"})
    same = texts["id"].eqNullSafe(exceptions["of"]) & (texts["tag"] == exceptions["of_tag"])
    joined = texts.join(exceptions, same, "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        known = Occurrences(*sent.value)
        for batch in batches:
            for part in W.slices(batch.column(1)):
                begin, end = _edges(_window_flags(part, batch.column(2), known, length, gram))
                gone = np.zeros(len(part.raw) + 1, np.int32)
                np.add.at(gone, begin, 1)
                np.add.at(gone, end - 1 + length, -1)
                gone = np.cumsum(gone)[:-1] > 0
                removed, digests = [], []
                for k in range(len(part.rows)):
                    low, high = part.bounds[k], part.bounds[k + 1]
                    own, raw = gone[low:high], part.raw[low:high]
                    removed.append([{"begin": int(a), "end": int(b)} for a, b in zip(*_edges(own), strict=True)])
                    digests.append(hashlib.sha256((raw[~own] if removed[-1] else raw).tobytes()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.rows[0], len(part.rows)), pa.array(np.diff(part.bounds), pa.int64()),
                     pa.array(removed, kind), pa.array(digests)],
                    ["id", "n_bytes", "spans", "kept_sha256"],
                )

    return joined.select("id", "text", "contexts").mapInArrow(
        cut, f"id {dict(texts.dtypes)['id']}, n_bytes bigint, spans {RUNS}, kept_sha256 string"
    )


def n_removed(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["begin"])
