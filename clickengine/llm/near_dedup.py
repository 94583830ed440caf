"""Near-duplicate documents by a chosen-path similarity join of shingle sets.

A document is a row: the set of its 5-word shingles.  Texts with the same set are one class,
which a hash of the set names, whatever the ids of its rows.  Each class gets a sketch of ``COORDINATES`` minwise tokens.  In a tree, the path to a node names
one or, with chance 1 / threshold - 1, two coordinates, and a class goes on to the children
that its tokens there name; two sets of similarity J part ways at a step with chance 1 - J.
Nodes with few classes are compared exhaustively, larger ones branch on, and ``TREES``
independent trees bring the recall to the target.

Node comparisons on sketches, with a margin of four deviations, only say which classes may be
linked; candidate components of bounded size, or the tree nodes of larger ones, then get the
whole texts once, and links are confirmed on the full sets, by blocks where the texts of a group
are long together.  Groups of any size are thus met
in nodes, and what is emitted is a star for each component found in a node: connected documents
stay connected by at most one row each.  Nodes that branching can't bring down are first met in
parts with common hubs; classes that this leaves unconnected are compared with all classes of
those nodes, block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickengine.llm.common import LOWER, SPACE, PrefixHash, blocks, materialize, mix, ragged, text_buffer, whole_groups, word_bounds
from clickengine.llm.graph import components, local_components

WORDS = 5
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Minwise tokens in a sketch.
COORDINATES = 128
#: Equal sketch bytes from which a pair is a candidate: four deviations below the mean at the threshold.
CANDIDATE = 76
#: Independent trees.  A pair at the threshold meets in a node of depth 2 of one tree with
#: chance 0.69, of depth 6 with 0.44: twelve trees miss it with chance 1e-6 and 1e-3.
TREES = 12
#: Classes of a node that are compared exhaustively (two million pairs of short sketches).
NODE = 2048
#: Each round goes two steps down.  What so many rounds can't split is mostly alike all through.
ROUNDS = 6
#: Of a node that stays large, so many classes are first compared with all the others.
HUBS = 32
#: Classes of a candidate component whose texts are compared in one go.
GROUP = 2048
#: Shingles of the texts that are compared in one go; more are compared by pairs of blocks.
GROUP_SHINGLES = 1 << 22
#: Bytes of texts that a task gathers before it compares the whole groups among them.
CONFIRM_BYTES = 16 << 20

_LAST = 2**63 - 1
_C = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingle hashes of each text of a block."""
    data = LOWER[data]
    start, end, first = word_bounds(data, offsets, SPACE)
    word = PrefixHash(data, 3).of(start, end) + (end - start).astype(np.uint64)
    n, counts = len(offsets) - 1, np.diff(first)
    text_of = np.repeat(np.arange(n), counts)
    m = max(len(word) - WORDS + 1, 0)
    value = np.zeros(m, np.uint64)
    for k in range(WORDS):
        value = value * _C + word[k:k + m]
    whole = np.flatnonzero(text_of[:m] == text_of[WORDS - 1:]) if m else np.zeros(0, np.int64)
    text, value = text_of[whole], mix(value[whole])
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):  # the whole sequence as one shingle, told apart by its length
        one = np.zeros(len(short), np.uint64)
        for k in range(WORDS - 1):
            has = counts[short] > k
            one[has] = one[has] * _C + word[first[short[has]] + k]
        text = np.concatenate((text, short))
        value = np.concatenate((value, mix(one + counts[short].astype(np.uint64))))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return value[new], np.searchsorted(text[new], np.arange(n + 1))


def _sketch(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The minwise tokens (32 bits) of each non-empty set: an array of sets by coordinates."""
    some = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, COORDINATES), np.uint32)
    if not len(some):
        return out
    rng = np.random.default_rng(23)
    salt, factor = (rng.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in "ab")
    for c in range(COORDINATES):
        token = ((value ^ salt[c]) * factor[c] >> np.uint64(32)).astype(np.uint32)
        out[some, c] = np.minimum.reduceat(token, first[some])
    return out


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        for i, j in blocks(offsets):
            value, first = shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            sketch = _sketch(value, first)
            sets = [hashlib.blake2b(value[a:b].tobytes(), digest_size=16).digest()
                    for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(np.diff(first)),
                 pa.array(sets, pa.binary()), pa.array([row.tobytes() for row in sketch], pa.binary())],
                ["doc", "mark", "n", "set", "sketch"])


def _matrix(column: pa.Array, kind) -> np.ndarray:
    data, offsets = text_buffer(column)
    return data.view(kind).reshape(len(offsets) - 1, -1)


def _step(path: np.ndarray, sketch: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(child paths, rows) one step down from ``path`` of the sets ``row``."""
    pick = mix(path ^ np.uint64(0xA5A5A5A5))
    second = (pick >> np.uint64(32)) % np.uint64(300) < np.uint64(100 * (100 - PERCENT) * 3 // PERCENT)
    out_path, out_row = [], []
    for which, there in ((0, np.ones(len(path), bool)), (1, second)):
        c = (mix(path + np.uint64(which + 1)) % np.uint64(COORDINATES)).astype(np.int64)[there]
        token = sketch[row[there], c].astype(np.uint64)
        out_path.append(mix(path[there] * _C + (token << np.uint64(8) | c.astype(np.uint64))))
        out_row.append(row[there])
    return np.concatenate(out_path), np.concatenate(out_row)


def _emit(path, rep) -> Iterator[pa.RecordBatch]:
    node = path.view(np.int64)
    for i in range(0, len(node), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(node[i:i + 100_000]), pa.array(rep[i:i + 100_000])], ["node", "rep"])


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: (rep, sketch[, node]) to the (node, rep) rows two steps down, from the roots of
    all trees without a node."""
    for batch in batches:
        sketch = _matrix(batch.column(1), np.uint32)
        rep, n = np.asarray(batch.column(0)), batch.num_rows
        for i in range(0, n, 20_000):
            part = np.arange(i, min(n, i + 20_000))
            if batch.num_columns == 2:
                row = np.tile(part, TREES)
                path = mix(np.repeat(np.arange(1, TREES + 1, dtype=np.uint64), len(part)))
            else:
                row, path = part, np.asarray(batch.column(2)).view(np.uint64)[part]
            for _ in range(2):
                path, row = _step(path, sketch, row)
            yield from _emit(path, rep[row])


def _pairs_within(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of each of many small groups."""
    rows = ragged(first, size)
    inside = ragged(np.zeros(len(size), np.int64), size)
    after = np.repeat(size, size) - inside - 1
    return np.repeat(rows, after), ragged(rows + 1, after)


def _star(rep: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The links of each component as rows (member, smallest member)."""
    label = local_components(len(rep), i, j)
    low = np.full(len(rep), _LAST)
    np.minimum.at(low, label, rep)
    hub = low[label]
    out = np.flatnonzero(hub != rep)
    pairs = np.unique(np.stack([rep[out], hub[out]]), axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])


def _compare_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: (node, rep, bytes) sorted by node to candidate links."""
    for table, first in whole_groups(batches, "node", 20_000):
        rep = np.asarray(table.column("rep").combine_chunks())
        sketch = _matrix(table.column("bytes"), np.uint8)
        size = np.diff(np.append(first, len(rep)))
        small = (size > 1) & (size <= 16)
        i, j = _pairs_within(first[small], size[small])
        good = np.concatenate([(sketch[i[a:a + 50_000]] == sketch[j[a:a + 50_000]]).sum(1) >= CANDIDATE
                               for a in range(0, len(i), 50_000)] or [np.zeros(0, bool)])
        left, right = [i[good]], [j[good]]
        for a, n in zip(first[size > 16].tolist(), size[size > 16].tolist()):
            own = sketch[a:a + n]
            for x in range(0, n, 64):
                same = (own[x:x + 64, None, :] == own[None, x:, :]).sum(2) >= CANDIDATE
                p, q = np.nonzero(same)
                up = q > p
                left.append(a + x + p[up])
                right.append(a + x + q[up])
        yield from _star(rep, np.concatenate(left), np.concatenate(right))


def _linked(value: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs among the sets ``rows``, by their full intersections."""
    size = (first[1:] - first[:-1])[rows]
    n = len(rows)
    at = ragged(first[rows], size)
    owner = np.repeat(np.arange(n), size)
    _, token = np.unique(value[at], return_inverse=True)
    count = np.bincount(token)
    shared = count[token] > 1  # a shingle of one set adds to no intersection
    owner, token = owner[shared], (np.cumsum(count > 1) - 1)[token[shared]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    both = np.zeros((n, n), np.float32)
    width = max(64, (1 << 22) // n)
    total = int(token[-1]) + 1 if len(token) else 0
    for c in range(0, total, width):
        a, b = np.searchsorted(token, (c, c + width))
        has = np.zeros((n, min(width, total - c)), np.float32)
        has[owner[a:b], token[a:b] - c] = 1
        both += has @ has.T
    left, right = [], []
    for a in range(0, n, 256):  # float32 holds the counts exactly up to 2**24 shingles
        part = both[a:a + 256].astype(np.int64)
        union = size[a:a + 256, None] + size[None, :] - part
        i, j = np.nonzero((100 * part >= PERCENT * union) & (union > 0))
        left.append(rows[a + i[j > a + i]])
        right.append(rows[j[j > a + i]])
    return np.concatenate(left), np.concatenate(right)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: (grp, rep, text) sorted by grp to confirmed links."""
    for table, first in whole_groups(batches, "grp", 1000, CONFIRM_BYTES):
        rep = np.asarray(table.column("rep").combine_chunks())
        data, offsets = text_buffer(table.column("text"))
        parts = [shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in blocks(offsets)]
        value = np.concatenate([v for v, _ in parts])
        sizes = np.concatenate([np.diff(f) for _, f in parts])
        at = np.concatenate(([0], np.cumsum(sizes)))
        found = [_linked(value, at, np.arange(a, b)) for a, b in zip(first, np.append(first[1:], len(rep))) if b - a > 1]
        i = np.concatenate([x for x, _ in found] or [np.zeros(0, np.int64)])
        j = np.concatenate([y for _, y in found] or [np.zeros(0, np.int64)])
        yield from _star(rep, i, j)


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: (node, rep, part, bytes) sorted by node to (grp, rep): what candidate links between
    classes of different parts connect in a node."""
    for table, first in whole_groups(batches, "node", 1000):
        node, rep, part = (np.asarray(table.column(c).combine_chunks()) for c in ("node", "rep", "part"))
        sketch = _matrix(table.column("bytes"), np.uint8)
        for a, b in zip(first.tolist(), np.append(first[1:], len(rep)).tolist()):
            own, of = sketch[a:b], part[a:b]
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for x in range(0, b - a, 64):
                same = (own[x:x + 64, None, :] == own[None, x:, :]).sum(2) >= CANDIDATE
                p, q = np.nonzero(same & (of[x:x + 64, None] != of[None, x:]))
                up = q > p
                left.append(x + p[up])
                right.append(x + q[up])
            label = local_components(b - a, np.concatenate(left), np.concatenate(right))
            some = np.flatnonzero(np.bincount(label, minlength=b - a)[label] > 1)
            grp = mix(mix(node[a:b].view(np.uint64)[some]) + label[some].astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(grp.view(np.int64)), pa.array(rep[a:b][some])], ["grp", "rep"])


def _leaves(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(node, rep): the nodes of all trees that are compared, with two classes or more each, and
    the nodes that stay large (None without any), of which the first hold only parts."""
    leaves, large = [], None
    level = classes.select("rep", "sketch").mapInArrow(_branch, "node long, rep long")
    for depth in range(ROUNDS):
        sizes = level.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        level = materialize(level.join(sizes, "node"))
        leaves.append(level.where(F.col("size") <= NODE).select("node", "rep"))
        level = level.where(F.col("size") > NODE)
        if level.isEmpty():
            break
        if depth + 1 < ROUNDS:
            level = (level.join(classes.select("rep", "sketch"), "rep").select("rep", "sketch", "node")
                     .mapInArrow(_branch, "node long, rep long"))
    else:
        # Mostly alike all through: parts of a node, each with the node's hubs, picked anew by every tree.
        large = level.select("node", "rep")
        rank = F.xxhash64("rep", "node")
        parts = F.ceil(F.col("size") / (NODE - HUBS)).cast("long")
        hubs = level.withColumn("_r", F.row_number().over(Window.partitionBy("node").orderBy(rank))).where(F.col("_r") <= HUBS)
        spread = hubs.select("rep", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("p"), "node")
        leaves.append(level.select(F.xxhash64("node", F.pmod(rank, parts)).alias("node"), "rep"))
        leaves.append(spread.select(F.xxhash64("node", "p").alias("node"), "rep"))
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return out, large


def _comparisons(leaves: DataFrame, candidates: DataFrame) -> DataFrame:
    """(grp, rep): whose texts are compared together.  A candidate component of up to ``GROUP``
    classes is one group; of a larger one, the classes of each tree node are."""
    found = materialize(components(candidates))
    members = found.unionByName(found.select(F.col("c").alias("u"), "c")).distinct()
    sizes = members.groupBy("c").agg(F.count(F.lit(1)).alias("size"))
    members = members.join(sizes, "c")
    small = members.where(F.col("size") <= GROUP).select(F.xxhash64(F.lit(1), "c").alias("grp"), F.col("u").alias("rep"))
    large = members.where(F.col("size") > GROUP).select(F.col("u").alias("rep"), "c")
    in_nodes = leaves.join(large, "rep").select(F.xxhash64(F.lit(2), "node", "c").alias("grp"), "rep").distinct()
    return small.unionByName(in_nodes)


def _in_bounds(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """(grp, rep) with at most about ``GROUP_SHINGLES`` shingles a group: the classes of a group of more
    are dealt out to blocks of half as many, and every two blocks are a group, so that no pair is lost."""
    rows = groups.join(classes.select("rep", "n"), "rep")
    sizes = rows.groupBy("grp").agg(F.ceil(F.sum("n") * 2 / GROUP_SHINGLES).alias("blocks")).where("blocks > 2")
    rows = groups.join(sizes, "grp", "left").withColumn("block", F.pmod(F.xxhash64("rep", "grp"), F.col("blocks")))
    other = F.when(F.col("blocks").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.withColumn("other", F.explode(other)).where("blocks IS NULL OR block <> other")
    pair = F.xxhash64("grp", F.least("block", "other"), F.greatest("block", "other"))
    return rows.select(F.when(F.col("blocks").isNull(), F.col("grp")).otherwise(pair).alias("grp"), "rep")


def _unconnected(large: DataFrame, links: DataFrame, sketches: DataFrame) -> DataFrame:
    """(grp, rep): whose texts are compared for the pairs of large nodes that ``links`` don't connect.

    Large nodes that share a class are one clump, so that a pair is met once and not in every
    tree.  The classes outside of a clump's largest component are compared with all of the
    clump by pairs of blocks: of one that is alike all through nothing is left, and what is left
    costs its share of the clump's pairs, in tasks of about ``NODE`` classes.
    """
    low = large.groupBy("node").agg(F.min("rep").alias("v"))
    clumps = components(large.join(low, "node").where("rep <> v").select(F.col("rep").alias("u"), "v"))
    found = components(links).select("u", F.col("c").alias("part"))
    members = materialize(clumps.join(found, "u", "left").select(
        F.col("u").alias("rep"), F.col("c").alias("clump"), F.coalesce("part", "u").alias("part")))
    block = NODE // 2
    sizes = members.groupBy("clump", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("clump").agg(
        F.max(F.struct("n", "part")).alias("m"), F.sum("n").alias("all"))
    sizes = sizes.where(F.col("all") > F.col("m.n")).select(
        "clump", F.col("m.part").alias("main"), F.ceil((F.col("all") - F.col("m.n")) / block).alias("others"),
        F.ceil(F.col("m.n") / block).alias("mains"))
    # Blocks 0 .. others - 1 lie outside of the largest component, the next ones in it.
    rank, is_main = F.xxhash64("rep", "clump"), F.col("part") == F.col("main")
    rows = members.join(sizes, "clump").withColumn("block", F.when(
        is_main, F.col("others") + F.pmod(rank, F.col("mains"))).otherwise(F.pmod(rank, F.col("others"))))
    last = F.col("others") + F.when(is_main, F.lit(0)).otherwise(F.col("mains")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).where("block <> other")
    node = F.xxhash64("clump", F.least("block", "other"), F.greatest("block", "other"))
    rows = rows.select(node.alias("node"), "rep", "part").join(sketches, "rep").select("node", "rep", "part", "bytes")
    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(_compare_blocks, "grp long, rep long")


def _mark(text: Column) -> Column:
    """Tells texts apart."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _report(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc (the id), mark (of the text), n, low (smallest id of the component) and kept of every row."""
    source = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"), _mark(F.col(text)).alias("mark"))
    sets = materialize(source.mapInArrow(_sketch_task, "doc long, mark binary, n long, set binary, sketch binary"))
    # A null id comes after all others.
    row = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "mark")
    classes = materialize(sets.where("n > 0").groupBy("set").agg(F.min(F.struct(row.alias("first"), "n", "sketch")).alias("m"))
                          .select("set", F.xxhash64("set").alias("rep"), "m.first", "m.n", "m.sketch"))
    leaves, large = _leaves(classes)
    leaves = materialize(leaves)
    # The low byte of every minwise token.
    small = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda i: F.substring(
        F.hex("sketch"), i * 8 + 1, F.lit(2))), ""))
    sketches = classes.select("rep", small.alias("bytes"))
    rows = leaves.join(sketches, "rep").select("node", "rep", "bytes")
    candidates = rows.repartition("node").sortWithinPartitions("node").mapInArrow(_compare_sketches, "u long, v long")

    def confirmed(groups: DataFrame) -> DataFrame:
        groups = materialize(_in_bounds(materialize(groups), classes))
        want = groups.select("rep").distinct().join(classes, "rep").select(
            "rep", F.col("first.doc").alias("_doc"), F.col("first.mark").alias("_mark"))
        texts = source.join(want, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark"))).select("rep", "text")
        whole = groups.join(texts.dropDuplicates(["rep"]), "rep").select("grp", "rep", "text")  # rows repeat
        return whole.repartition("grp").sortWithinPartitions("grp").mapInArrow(_confirm, "u long, v long")

    links = confirmed(_comparisons(leaves, candidates))
    if large is not None:
        links = materialize(links)
        links = links.unionByName(confirmed(_unconnected(large, links, sketches)))
    found = materialize(components(links).withColumnRenamed("u", "rep").join(classes.select("rep", "first"), "rep"))
    lowest = found.groupBy("c").agg(F.min("first").alias("lowest"))
    found = found.join(lowest, "c").select("rep", "lowest")
    out = (sets.select("doc", "mark", "n", "set").join(classes.select("set", "rep", "first"), "set", "left")
           .join(found, "rep", "left").withColumn("of", F.coalesce("lowest", "first", row)))
    return out.select("doc", "mark", "n", F.col("of.doc").alias("low"),
                      (F.col("of.doc").eqNullSafe(F.col("doc")) & (F.col("of.mark") == F.col("mark"))).alias("kept"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_shingles, component_id (smallest id reachable by links) and kept of every row.

    A document of fewer words than a shingle is one shingle; a null or empty text has none and
    is linked with nothing.  Links are those of the texts: rows of one id, or of a null id, with
    different texts are different documents.  A component is null only if it reaches no id.  Kept
    is the text of the smallest id (the first of several by a hash), in all its repeated rows.
    Other columns aren't read.
    """
    kind = docs.select(key).schema[0].dataType
    return _report(docs, key, text).select(F.col("doc").cast(kind).alias(key), F.col("n").alias("n_shingles"),
                                           F.col("low").cast(kind).alias("component_id"), "kept")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept of their component, with all their columns; of repeated rows
    (the same id and text), one stays.  Rows without an id and a word are no copies of each other."""
    gone = _report(docs, key, text).where(~F.col("kept")).select(F.col("doc").alias("_doc"), F.col("mark").alias("_gone")).distinct()
    columns = docs.columns
    one = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    k, t = f"c{columns.index(key)}", f"c{columns.index(text)}"
    one = one.withColumns({"_id": F.col(k).cast("long"), "_mark": _mark(F.col(t))})
    one = one.join(gone, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_mark") == F.col("_gone")), "left_anti")
    lone = F.col("_id").isNull() & F.coalesce(F.col(t).cast("string"), F.lit("")).rlike(r"\A[ \t\n\x0B\f\r]*\z")
    one = one.withColumn("_lone", F.when(lone, F.monotonically_increasing_id()))
    first = F.row_number().over(Window.partitionBy("_id", "_mark", "_lone").orderBy("_mark"))
    one = one.withColumn("_n", first).where("_n = 1")
    return one.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
