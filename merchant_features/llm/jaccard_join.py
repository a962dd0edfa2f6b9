"""N-gram Jaccard join by set-relation skipping.

Documents are sets of word n-grams; two link when their Jaccard similarity
reaches a threshold. Equal sets are one class from the start. The steps:

1. Document frequencies of all n-grams, from one shuffle of packed 32-bit
   residues. They fix a global order: n-grams that occur once, then the others,
   by grades of their number, the frequent ones last. What tasks are sent of it
   is bounded: bitmaps of at most 2^27 bits (an n-gram not in the first occurs
   once; when one fills up it tells less apart, results stay) and the n-grams of
   at least ``N / HOT`` occurrences, of which there can be no more than ``HOT``.
2. Each class puts the first |x| - ceil(t|x|) + 1 n-grams of its order into the
   index; two linked classes share one of these. N-grams that occur once open no
   list, so most documents enter nothing.
3. An index list is cut into blocks by the sizes of its sets. A block knows its
   best position; an entry is skipped where no block of like sizes leaves room
   for the overlap that the threshold asks for.
4. A list's leader is the entry at the first position: it has the fewest rare
   n-grams in front, as the origin of many near copies has. Lists with one
   leader L are one group, and a set x is in it once, however many lists they
   share. The leader is compared with each, which gives L - x and x - L. These
   are its answers, and they give the answers of all others without comparing
   the sets again:
   ``|x & y| = |L| - |L - x| - |L - y| + |(L - x) & (L - y)| + |(x - L) & (y - L)|``.
   Near copies differ little, so little is compared. Groups of more than
   ``BLOCK_SETS`` sets are compared block by block, the leader sent to each.
5. A pair that is in several groups counts in the first of them. What leaves a
   task are each class's number of linked documents (copies counted by the sizes
   of their classes) and one edge per class that joins it to the group; the
   linked pairs themselves are returned only where they are asked for.

Defined cases: null, empty or blank text is an empty set and linked with
nothing. Rows with a null id take no part and have a null component. Rows of
one id are separate texts with the same name. Repeated rows are one class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_features.llm import words as W
from merchant_features.llm.components import components
from merchant_features.llm.frames import broadcast_fields, row_columns, row_struct
from merchant_features.llm.groups import first_shared, reachable
from merchant_features.llm.occurrences import GRADES, Occurrences, bits_for, count, in_bitmap, slot_bitmap
from merchant_features.sources.storage import materialize

ID_BITS = 23
#: Larger groups are compared block by block, with blocks of about so many classes and n-grams.
BLOCK_SETS = 512
BLOCK_GRAMS = 1 << 20
#: Blocks hold classes of like size, in steps of 2 %.
STEP = 1.02


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes); a text with fewer words has its whole sequence as one."""
    for part in W.slices(texts):
        w = W.words(part, W.SOLID)
        grams = W.shingles(w.hashes, n)
        for k, row in enumerate(part.rows):
            low, high = int(w.first[k]), int(w.first[k + 1])
            if high - low >= n:
                yield row, np.unique(grams[low : high - n + 1])
            else:
                yield row, W.shingles(w.hashes[low:high], high - low) if high > low else np.zeros(0, np.uint64)


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def ranked(tokens: np.ndarray, occurrences: Occurrences) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams in the global order, rarest first, and which of them may occur more than once."""
    shared = occurrences.may_repeat(tokens)
    rank = np.where(shared, occurrences.frequencies(tokens) + 1, 0)
    order = np.lexsort((tokens, rank))
    return tokens[order], shared[order]


def _indexed(docs: DataFrame, occurrences, n: int, percent: int, id_type: str) -> DataFrame:
    """Rows of two kinds: (id, tag, size, digest) of every document; (size, digest, token, pos) of index entries."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "tag", "size", "digest", "token", "pos"]
        entered: set[bytes] = set()  # classes this task has entered: copies add nothing
        known = Occurrences(*occurrences.value)
        for batch in batches:
            ids, sizes, digests, rows = batch.column(0), [], [], []
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            for row, tokens in shingle_sets(batch.column(2), n):
                sizes.append(len(tokens))
                digests.append(digest(tokens) if len(tokens) else None)
                if not len(tokens) or not named[row] or digests[-1] in entered:
                    continue
                entered.add(digests[-1])
                prefix = len(tokens) - -(-len(tokens) * percent // 100) + 1
                ordered, shared = ranked(tokens, known)
                at = np.flatnonzero(shared[:prefix])
                if len(at):
                    rows.append((len(tokens), digests[-1], ordered[at].view(np.int64), at))
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column(1), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                 pa.nulls(len(sizes), pa.int64()), pa.nulls(len(sizes), pa.int32())], names,
            )
            if rows:
                counts = [len(r[3]) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(sum(counts), ids.type),
                        pa.nulls(sum(counts), pa.int64()),
                        pa.array(np.repeat([r[0] for r in rows], counts).astype(np.int32)),
                        pa.array([r[1] for r in rows], pa.binary()).take(pa.array(np.repeat(np.arange(len(rows)), counts))),
                        pa.array(np.concatenate([r[2] for r in rows])),
                        pa.array(np.concatenate([r[3] for r in rows]).astype(np.int32)),
                    ],
                    names,
                )

    return docs.mapInArrow(entries, f"id {id_type}, tag bigint, size int, digest binary, token bigint, pos int")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(digest, tokens) of the wanted classes; ``wanted`` has id and digest.

    The ids go to the tasks as a bitmap of fixed size, which lets a few others
    through; the join keeps what is wanted.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << ID_BITS)).alias("slot")
    bitmap = slot_bitmap(wanted.select(slot), ID_BITS)
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = np.flatnonzero(in_bitmap(sent.value, batch.column(1).to_numpy()))
            sets = [t for _, t in shingle_sets(batch.column(0).take(pa.array(stay)), n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(t) for t in sets], pa.binary()), pa.array([t.tobytes() for t in sets], pa.binary())],
                ["digest", "tokens"],
            )

    read = docs.select("text", slot)
    sets = read.mapInArrow(kept, "digest binary, tokens binary")
    return materialize(sets.join(wanted.select("digest").distinct(), "digest").dropDuplicates(["digest"]))


def _size_step() -> Column:
    return F.floor(F.log(STEP, F.col("size"))).cast("int")


def _reach(percent: int) -> int:
    """Steps of size that two linked sets can be apart."""
    return int(np.ceil(np.log(100 / percent) / np.log(STEP))) + 1


def _with_room(entries: DataFrame, percent: int) -> DataFrame:
    """Index entries that another class of their list may link to, by sizes and positions of the list's blocks.

    A class may be entered by several tasks; its entries are equal and count as one.
    """
    name = F.xxhash64("digest")
    blocks = entries.groupBy("token", _size_step().alias("step")).agg(
        F.min(name).alias("first"), F.max(name).alias("last"), F.min("size").alias("least"),
        F.max(F.col("size") - F.col("pos")).alias("best"),
    )
    near = Window.partitionBy("token").orderBy("step").rangeBetween(-_reach(percent), _reach(percent))
    seen = blocks.select(
        "token", "step", F.min("first").over(near).alias("first"), F.max("last").over(near).alias("last"),
        F.min("least").over(near).alias("least"), F.max("best").over(near).alias("best"),
    ).where("first <> last").drop("first", "last")
    room = F.least(F.col("size") - F.col("pos"), F.col("best")) * (100 + percent) >= percent * (F.col("size") + F.col("least"))
    found = entries.withColumn("step", _size_step()).join(seen, ["token", "step"]).where(room)
    return found.select("token", "digest", "size", "pos")


def _counts(xs: list[np.ndarray], ys: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every x with every y."""
    x, y = np.concatenate(xs), np.concatenate(ys)
    total = np.zeros((len(xs), len(ys)), np.float64)
    both = np.intersect1d(x, y)
    if not len(both):
        return total.astype(np.int64)
    of_x, of_y = (np.repeat(np.arange(len(v)), [len(t) for t in v]) for v in (xs, ys))
    for low in range(0, len(both), step):
        some = both[low : low + step]
        sides = []
        for tokens, owner, n in ((x, of_x, len(xs)), (y, of_y, len(ys))):
            at = np.minimum(np.searchsorted(some, tokens), len(some) - 1)
            inside = some[at] == tokens
            side = np.zeros((n, len(some)), np.float32)
            side[owner[inside], at[inside]] = 1
            sides.append(side)
        total += sides[0] @ sides[1].T
    return total.astype(np.int64)


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """(leader, digest) of the groups, in every pair of blocks that a class is compared in, and the leader with each.

    ``members`` has leader, digest and size; ``role`` is 0 and 1 for the two blocks of a pair and 2 for their leader.
    """
    sizes = members.groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("grams"))
    large = (F.col("n") > BLOCK_SETS) | (F.col("grams") > BLOCK_GRAMS)
    sizes = sizes.where("n > 1").select("leader", large.alias("large"))
    stepped = members.join(sizes, "leader").withColumn("step", F.when(F.col("large"), _size_step()).otherwise(-1))
    stepped = materialize(stepped.drop("large"))
    cells = materialize(
        stepped.groupBy("leader", "step").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_GRAMS)).cast("int").alias("parts"),
            F.min("size").alias("least"), F.max("size").alias("most"),
        )
    )
    x = cells.select("leader", *[F.col(c).alias(f"{c}_a") for c in ("step", "parts", "least", "most")])
    x = x.withColumn("step_b", F.explode(F.sequence("step_a", F.when(F.col("step_a") < 0, -1).otherwise(F.col("step_a") + _reach(percent)))))
    y = cells.select("leader", *[F.col(c).alias(f"{c}_b") for c in ("step", "parts", "least", "most")])
    near = x.join(y, ["leader", "step_b"]).where(
        f"100 * most_a >= {percent} * least_b AND 100 * most_b >= {percent} * least_a"
    )
    blocks = near.withColumn("part_a", F.explode(F.sequence(F.lit(0), F.col("parts_a") - 1))).withColumn(
        "part_b", F.explode(F.sequence(F.lit(0), F.col("parts_b") - 1))
    ).where("step_a < step_b OR part_a <= part_b")
    key = ["leader", "step_a", "part_a", "step_b", "part_b"]
    blocks = materialize(blocks.select(*key))
    placed = stepped.join(cells.select("leader", "step", "parts"), ["leader", "step"]).select(
        "leader", "digest", "step", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int").alias("part")
    )
    rows = blocks.select(*key, F.col("leader").alias("digest"), F.lit(2).alias("role"))
    for role, (side, wanted) in enumerate((("a", blocks), ("b", blocks.where("step_a < step_b OR part_a < part_b")))):
        keyed = placed.withColumnsRenamed({"step": f"step_{side}", "part": f"part_{side}"})
        joined = wanted.join(keyed, ["leader", f"step_{side}", f"part_{side}"])
        rows = rows.unionByName(joined.select(*key, "digest", F.lit(role).alias("role")))
    return rows


def _linked(blocks: DataFrame, percent: int, listed: bool) -> DataFrame:
    """Written once: (digest, others, root) of the classes linked in a block, or all linked (a, b, overlap)."""

    def compare(group: pa.Table) -> pa.Table:
        role = group.column("role").to_numpy()
        sets = [np.frombuffer(t.as_buffer(), np.uint64) for t in group.column("tokens")]
        leader = sets[int(np.flatnonzero(role == 2)[0])]
        # what each class lacks and has beside the leader: the leader's answers
        fewer = [np.setdiff1d(leader, own, True) for own in sets]
        more = [np.setdiff1d(own, leader, True) for own in sets]
        size, leader_size = np.array([len(own) for own in sets], np.int64), len(leader)
        x, y = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        alone = not len(y)
        if alone:
            y = x
        lacks = np.array([len(t) for t in fewer], np.int64)
        # the overlap is at least what the leader leaves to both, and grows by what they lack or have in common
        base = leader_size - lacks[x][:, None] - lacks[y][None, :]
        extra = size - (leader_size - lacks)
        most = base + np.minimum(lacks[x][:, None], lacks[y][None, :]) + np.minimum(extra[x][:, None], extra[y][None, :])
        total = size[x][:, None] + size[y][None, :]
        tried = (100 + percent) * most >= percent * total
        if alone:
            tried &= np.arange(len(x))[:, None] < np.arange(len(y))[None, :]
        in_x, in_y = np.flatnonzero(tried.any(1)), np.flatnonzero(tried.any(0))
        i = j = overlap = np.zeros(0, np.int64)
        if len(in_x):
            both = base[np.ix_(in_x, in_y)]
            for own in (fewer, more):
                both = both + _counts([own[k] for k in x[in_x]], [own[k] for k in y[in_y]])
            held = tried[np.ix_(in_x, in_y)] & ((100 + percent) * both >= percent * total[np.ix_(in_x, in_y)])
            k, m = np.nonzero(held)
            i, j, overlap = x[in_x[k]], y[in_y[m]], both[k, m]
        if len(i):
            first = first_shared(group.column("group_key")[0].as_py(), group.column("groups").combine_chunks(), i, j)
            i, j, overlap = i[first], j[first], overlap[first]
        digests = group.column("digest").combine_chunks()
        if listed:
            names = digests.to_pylist()
            swap = np.array([names[a] > names[b] for a, b in zip(i, j, strict=True)], bool)
            a, b = np.where(swap, j, i), np.where(swap, i, j)
            return pa.table(
                {"a": digests.take(pa.array(a)), "b": digests.take(pa.array(b)), "overlap": pa.array(overlap.astype(np.int32))}
            )
        copies, n = group.column("copies").to_numpy(), len(size)
        others = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
        told = np.flatnonzero(others > 0)
        root = reachable(n, i, j)
        return pa.table(
            {
                "digest": digests.take(pa.array(told)), "others": pa.array(others[told].astype(np.int64)),
                "root": digests.take(pa.array(root[told])),
            }
        )

    schema = "a binary, b binary, overlap int" if listed else "digest binary, others bigint, root binary"
    return materialize(blocks.groupBy("leader", "step_a", "part_a", "step_b", "part_b").applyInArrow(compare, schema))


@dataclass
class Joined:
    """``members``: (id, tag, size, digest, component, n_links) of every row, tag the text's hash, n_links the other
    documents it is linked to; ``links``: all linked (a, b, overlap) of classes, a < b, if asked for, else None."""

    members: DataFrame
    links: DataFrame | None


def similar_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90, links: bool = True
) -> Joined:
    """Components and numbers of links of the documents under Jaccard similarity of at least ``percent`` / 100.

    ``links`` names the linked pairs of classes as well, which grow with the square of a group.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    texts = docs.select(F.col(id_col).alias("id"), text).select("id", F.xxhash64("text").alias("tag"), "text")
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    occurrences = count(
        texts, lambda column: (t for _, t in shingle_sets(column, n)), n_bytes / 7, bitmap_bits=bits_for(n_bytes / 7),
        grades=len(GRADES),
    )
    sent = broadcast_fields(docs.sparkSession, occurrences)
    id_type = texts.schema["id"].dataType.simpleString()
    both = materialize(_indexed(texts, sent, n, percent, id_type))
    rows = both.where("token IS NULL").select("id", "tag", "size", "digest")
    named = rows.where("id IS NOT NULL AND digest IS NOT NULL")
    classes = materialize(named.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")))

    entries = materialize(_with_room(both.where("token IS NOT NULL").select("token", "digest", "size", "pos"), percent))
    lists = entries.groupBy("token").agg(
        F.min(F.struct("pos", "size", "digest"))["digest"].alias("leader"), F.min("digest").alias("first"), F.max("digest").alias("last")
    )
    grouped = entries.join(lists.where("first <> last"), "token").groupBy("leader", "digest").agg(F.first("size").alias("size"))
    grouped = materialize(grouped)
    wanted = grouped.select("digest").distinct().join(classes.select("digest", F.col("least").alias("id")), "digest")
    sets = _sets(texts, wanted, n)

    group_key = F.xxhash64("leader")
    groups = grouped.groupBy("digest").agg(F.sort_array(F.collect_set(group_key)).alias("groups"))
    known = groups.join(classes.select("digest", "copies"), "digest")
    blocks = _blocks(grouped, percent).join(known, "digest").join(sets, "digest").withColumn("group_key", group_key)
    told = _linked(blocks, percent, False)
    others = told.groupBy("digest").agg(F.sum("others").alias("others"))
    joined = components(told.select(F.col("digest").alias("a"), F.col("root").alias("b")))

    # a component is named by its smallest document
    of_class = materialize(
        classes.join(others, "digest", "left")
        .join(joined.withColumnsRenamed({"node": "digest", "component": "root"}), "digest", "left")
        .withColumn("root", F.coalesce("root", "digest"))
        .withColumn("n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
    )
    names = of_class.groupBy("root").agg(F.min("least").alias("component"))
    of_class = materialize(of_class.join(names, "root").select("digest", "component", "n_links"))
    component = F.when(F.col("digest").isNull() | F.col("id").isNull(), F.col("id")).otherwise(F.col("component"))
    n_links = F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links")
    named_rows = rows.join(of_class, "digest", "left").select("id", "tag", "size", "digest", component.alias("component"), n_links)
    return Joined(named_rows, _linked(blocks, percent, True) if links else None)


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80
) -> DataFrame:
    """One row of every component of ``docs``: the smallest id (null last), of several texts or rows of it one.

    Rows without words are linked with nothing and all stay.
    """
    key = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"))
    keyed = docs.select(row_struct(docs), key.alias("key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"))
    found = similar_sets(keyed, "key", "body", n, percent, links=False).members
    members = materialize(
        found.where("digest IS NOT NULL").groupBy("id", "tag", "component").agg(F.count(F.lit(1)).alias("n"))
    )
    stay = members.groupBy("component").agg(F.min(F.struct("id", "tag")).alias("first")).select("first.*", F.lit(True).alias("stays"))
    judged = members.join(stay, ["id", "tag"], "left").where("stays IS NULL OR n > 1")
    changed = materialize(judged.select(F.col("id").alias("key"), "tag", F.col("stays").isNotNull().alias("stays")))
    tagged = keyed.select("row", "key", F.xxhash64("body").alias("tag"))
    untouched = tagged.join(changed, ["key", "tag"], "left_anti")
    # of rows with one id and text one stays, whichever has the smallest hash
    repeated = tagged.join(changed.where("stays"), ["key", "tag"], "left_semi").withColumn("hash", F.xxhash64(F.to_json("row")))
    one = Window.partitionBy("key", "tag").orderBy("hash")
    chosen = repeated.withColumn("nth", F.row_number().over(one)).where("nth = 1")
    return untouched.select("row").unionByName(chosen.select("row")).select(*row_columns(docs))
