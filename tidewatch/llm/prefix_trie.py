"""The prefix trie of conversations, from z-fast tries of batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.llm.common import table

#: Turns in one piece of a conversation. A longer conversation is several pieces, so no row grows with it.
PIECE = 64
#: Pieces, or nodes, over which a running value is built at once; what crosses such a span comes from its total.
SPAN = 4096
#: Bytes of ids that are hashed as one row.
CHUNK = 1 << 16
NODE = ["depth", "fa", "fb"]


def fattest(low: int, high: int) -> int:
    """The number in ``(low, high]`` that the highest power of two divides."""
    return high & -(1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Compacted nodes of a batch of pieces, each found by the key of its handle.

    A path is a sequence of prefix keys: the key at a depth stands for all turns down to it. A node holds the depths
    ``(start, end]``; its handle is the path down to the two-fattest of them. A search looks up handles at the
    two-fattest depth of the interval that is left, so a path of n turns takes about log2(n) probes.
    """

    def __init__(self) -> None:
        self.handles: dict[bytes, int] = {}
        self.edges: dict[bytes, int] = {}
        self.start: list[int] = []
        self.end: list[int] = []
        self.parent: list[int] = []
        self.path: list[int] = []
        self.paths: list[tuple[int, list[bytes]]] = []

    def key(self, node: int, depth: int) -> bytes:
        base, keys = self.paths[self.path[node]]
        return keys[depth - base]

    def hang(self, node: int, start: int, parent: int) -> None:
        """Lets the edge of ``node`` begin at ``start``, with its handle and its parent's way to it."""
        self.start[node], self.parent[node] = start, parent
        self.handles[self.key(node, fattest(start, self.end[node]))] = node
        self.edges[self.key(node, start + 1)] = node

    def new(self, start: int, end: int, parent: int, path: int) -> int:
        self.start.append(start)
        self.end.append(end)
        self.parent.append(parent)
        self.path.append(path)
        self.hang(len(self.end) - 1, start, parent)
        return len(self.end) - 1

    def exit_node(self, base: int, keys: list[bytes]) -> tuple[int, int, int]:
        """The deepest node whose whole path the keys follow (-1: none), how deep it is, and the node below it that
        they enter but leave inside its edge (-1: none), by fat binary search."""
        low, high, inner = base, base + len(keys) - 1, -1
        top = high
        while low < high:
            at = fattest(low, high)
            node = self.handles.get(keys[at - base], -1)
            if node < 0:
                high = at - 1
            elif self.end[node] <= top and self.key(node, self.end[node]) == keys[self.end[node] - base]:
                low, inner = self.end[node], node
            else:
                return self.parent[node], self.start[node], node
        # An edge may be left above its handle.
        below = self.edges.get(keys[low + 1 - base], -1) if low < top else -1
        return inner, low, below

    def insert(self, base: int, keys: list[bytes]) -> int:
        """The node at the end of a path: ``keys`` are those at depths ``base`` and on."""
        top = base + len(keys) - 1
        above, depth, node = self.exit_node(base, keys)
        if depth == top:
            return above
        self.paths.append((base, keys))
        if node < 0:
            return self.new(depth, top, above, len(self.paths) - 1)
        same, other = depth + 1, min(self.end[node], top)
        while same < other:
            middle = (same + other + 1) // 2
            if self.key(node, middle) == keys[middle - base]:
                same = middle
            else:
                other = middle - 1
        del self.handles[self.key(node, fattest(self.start[node], self.end[node]))]
        fork = self.new(depth, same, above, self.path[node])
        self.hang(node, same, fork)
        return fork if same == top else self.new(same, top, fork, len(self.paths) - 1)

    def totals(self, ends: list[int], values: np.ndarray, least: bool) -> np.ndarray:
        """Per node, the sum (or smallest) of the values of all paths that pass it; ``ends`` are the paths' nodes."""
        out = np.full(len(self.end), np.iinfo(np.int64).max) if least else np.zeros(len(self.end), np.int64)
        (np.minimum if least else np.add).at(out, ends, values)
        for node in np.argsort(self.end)[::-1].tolist():
            if self.parent[node] >= 0:
                above = self.parent[node]
                out[above] = min(out[above], out[node]) if least else out[above] + out[node]
        return out


def batch_nodes(batch: pa.RecordBatch, sums: list[str], least: str | None) -> pa.RecordBatch:
    """The nodes of a batch of pieces, edges expanded to one row per depth, with the batch's sums over members."""
    pieces = batch.to_pydict()
    trie, ends, rows = ZFastTrie(), [], []
    for i, (base, a, b) in enumerate(zip(pieces["base"], pieces["a"], pieces["b"])):
        keys = np.bitwise_xor.accumulate(np.array([[pieces["fa"][i], *a], [pieces["fb"][i], *b]], np.int64), axis=1).T.copy()
        packed = keys.tobytes()
        known = len(trie.paths)
        ends.append(trie.insert(base, [packed[at : at + 16] for at in range(0, len(packed), 16)]))
        if len(trie.paths) > known:
            rows.append((keys, pieces["sizes"][i]))
    # In order of the nodes: the path's keys over the edge, with those one turn above.
    spans = [(n, s - trie.paths[p][0], e - trie.paths[p][0], p) for n, (s, e, p) in enumerate(zip(trie.start, trie.end, trie.path))]
    lengths = np.array([e - s for _, s, e, _ in spans])

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)

    here = joined([rows[p][0][s + 1 : e + 1] for _, s, e, p in spans])
    above = joined([rows[p][0][s:e] for _, s, e, p in spans])
    depth = [d for n, s, e, _ in spans for d in range(trie.start[n] + 1, trie.end[n] + 1)]
    size = [x for _, s, e, p in spans for x in rows[p][1][s:e]]
    columns = {
        "depth": pa.array(depth, pa.int64()), "fa": here[:, 0], "fb": here[:, 1], "pa": above[:, 0], "pb": above[:, 1], "size": pa.array(size, pa.int64())
    }
    for name in [*sums, *([least] if least else [])]:
        values = np.array(pieces[name], np.int64)
        columns[name] = np.repeat(trie.totals(ends, values, name == least), lengths) if spans else np.zeros(0, np.int64)
    return pa.RecordBatch.from_pydict({name: pa.array(values) for name, values in columns.items()})


def tries(pieces: DataFrame, sums: list[str], least: str | None = None) -> DataFrame:
    """The nodes of each batch of pieces. A node that several batches hold has a row from each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_nodes(batch, sums, least)

    names = ["depth", "fa", "fb", "pa", "pb", "size", *sums, *([least] if least else [])]
    columns = ["base", "fa", "fb", "a", "b", "sizes", *sums, *([least] if least else [])]
    return pieces.select(*columns).mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def running(df: DataFrame, key: str, place: str, values: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds to each row an aggregate of the rows of its key before it: ``values`` maps a new column to (function, column).

    A span of ``SPAN`` places is one window; what comes before the span is an aggregate of spans, so a long key is
    spread over as many tasks as it has spans.
    """
    df = df.withColumn("_span", F.expr(f"{place} div {SPAN}"))
    spans = df.groupBy(key, "_span").agg(*[F.expr(f"{f}({c})").alias(f"_{n}") for n, (f, c) in values.items()])
    ahead = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(key, "_span", *[F.coalesce(F.expr(f"{f}(_{n})").over(ahead), F.lit(0)).alias(f"_{n}") for n, (f, _) in values.items()])
    inside = Window.partitionBy(key, "_span").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)

    def both(name: str, function: str, column: str) -> Column:
        own = F.coalesce(F.expr(f"{function}({column})").over(inside), F.lit(0))
        return (own.bitwiseXOR(F.col(f"_{name}")) if function == "bit_xor" else own + F.col(f"_{name}")).alias(name)

    joined = df.join(spans, [key, "_span"])
    return joined.select(*[c for c in df.columns if c != "_span"], *[both(n, f, c) for n, (f, c) in values.items()])


def numbered_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``c``, ``i`` (place of the turn in its conversation, from 0), ``k`` (digest of role and text), ``size``.

    The turns are put into ranges of (conversation, order) and counted inside them; only a conversation that crosses
    ranges needs its counts before, one row per range that it has entered.
    """
    speaker, said = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    order = ["c", "turn", "role", "k"]
    thin = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("c"), F.col(turn).alias("turn"), speaker.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(speaker).cast("string"), F.lit(":"), speaker, said).cast("binary"))).alias("k"),
        F.octet_length(said).cast("bigint").alias("size"),
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            convs = batch.column("c").to_numpy()
            if not len(convs):
                continue
            new = np.flatnonzero(np.concatenate([[convs[0] != last], convs[1:] != convs[:-1]]))
            first = np.zeros(len(convs), np.int64)
            first[new] = new
            place = np.arange(len(convs)) - np.maximum.accumulate(first)
            if not len(new) or new[0]:
                place[: new[0] if len(new) else len(convs)] += seen
            last, seen = convs[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column("c"), pa.array(place), batch.column("k"), batch.column("size")], ["c", "i", "k", "size"])

    ranges = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = thin.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    counted = table(ranged.mapInArrow(count, "c bigint, i bigint, k binary, size bigint").withColumn("part", F.spark_partition_id()), "trie-turns")
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.groupBy("c", "part").agg(F.count("*").alias("n")).select("c", "part", F.sum("n").over(before).alias("start"))
    placed = counted.join(starts.where("start > 0"), ["c", "part"], "left")
    return placed.select("c", (F.col("i") + F.coalesce("start", F.lit(0))).alias("i"), "k", "size")


def rebuilt_pieces(turns: DataFrame, family: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (``c``, ``n_turns``) and their pieces: where each begins (``base``, and the key
    ``fa``, ``fb`` there) and its turns' parts of the key (``a``, ``b``) and ``sizes``."""
    head = turns.where((F.col("c") % family == 0) & (F.col("i") < heads - 1)).groupBy(F.col("c").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("i", "k", "size"))).alias("head")
    )
    convs = turns.groupBy("c").agg(F.count("*").alias("own")).select(
        "c", "own", (F.col("c") - F.col("c") % family).alias("base"), (F.crc32(F.col("c").cast("string").cast("binary")) % heads).cast("int").alias("h")
    )
    shared = F.slice(F.coalesce("head", F.expr("cast(array() as array<struct<i:bigint,k:binary,size:bigint>>)")), F.lit(1), F.col("h"))
    convs = table(
        convs.join(head, "base", "left").select("c", "h", shared.alias("head"))
        .join(convs.select("c", "own"), "c").withColumn("m", F.size("head").cast("bigint"))
        .withColumn("n_turns", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))),
        "trie-conversations",
    )
    taken = convs.select("c", F.posexplode("head").alias("place", "t")).select("c", F.col("place").cast("bigint").alias("place"), "t.k", "t.size")
    own = turns.join(convs.select("c", "h", "m"), "c").where("i >= h").select("c", (F.col("i") - F.col("h") + F.col("m")).alias("place"), "k", "size")
    rows = taken.unionByName(own).select(
        "c", "place", "size", F.xxhash64("place", "k").alias("a"), F.xxhash64("k", "place", F.lit(1)).alias("b")
    )
    pieces = rows.groupBy("c", F.expr(f"place div {PIECE}").alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("place", "a", "b", "size"))).alias("t"), F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb")
    )
    pieces = table(pieces, "trie-parts")
    whole = running(pieces, "c", "piece", {"fa": ("bit_xor", "xa"), "fb": ("bit_xor", "xb")})
    return convs, table(
        whole.select(
            "c", (F.col("piece") * PIECE).alias("base"), "fa", "fb", F.col("t.a").alias("a"), F.col("t.b").alias("b"), F.col("t.size").alias("sizes"),
            F.col("fa").bitwiseXOR(F.col("xa")).alias("ea"), F.col("fb").bitwiseXOR(F.col("xb")).alias("eb"),
        ),
        "trie-pieces",
    )


def id_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` per node of ``ends`` (columns ``NODE`` and ``c``): the ids in order, joined by commas.

    A hash takes its input in order, so a node's ids are joined to chunks where they lie, in ranges of (node, id), and
    one task per node takes the chunks one after the other.
    """

    most = CHUNK

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, 0, [], 0
        out: list[tuple] = []
        for batch in batches:
            for *at, c in zip(*(batch.column(n).to_pylist() for n in [*NODE, "c"])):
                if at != node or size >= most:
                    if ids:
                        out.append((*node, first, ",".join(ids)))
                    node, first, ids, size = at, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if sum(len(r[-1]) for r in out) >= most:
                yield chunks(out)
                out = []
        if ids:
            out.append((*node, first, ",".join(ids)))
        yield chunks(out)

    def chunks(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string())], [*NODE, "first", "ids"])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *at, ids in zip(*(batch.column(n).to_pylist() for n in [*NODE, "ids"])):
                if at == node:
                    state.update(b"," + ids.encode())
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(ids.encode())
            yield digests(out)
        yield digests([(*node, state.hexdigest())] if node else [])

    def digests(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], [*NODE, "ends_sha256"])

    key = ", ".join(f"{n} bigint" for n in NODE)
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = ends.repartitionByRange(parts, *NODE, "c").sortWithinPartitions(*NODE, "c").mapInArrow(join, f"{key}, first bigint, ids string")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, f"{key}, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, family: int = 5, heads: int = 9,
    conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    Conversation c is rebuilt as the first h original turns of conversation ``c - c % family``, then its own after its
    first h, with h the crc32 of its decimal number modulo ``heads``. A node is a distinct sequence of first turns
    (role and text), the root the empty one; its members are the conversations that begin with it. One row per node:
    ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes in its subtree, itself included), ``saved_tokens`` (summed over its subtree, each
    node's members but one times the UTF-8 bytes of its last text) and ``ends_sha256`` (of the decimal numbers of the
    members that end in it, ascending, joined by commas).

    Turns are in order of ``turn``, null first; equal ones by role, then by the digest of role and text; rows equal in
    these as well are equal turns, and all count. A null role or text is empty. Rows without a conversation number are
    left out, and an empty table gives no node. Conversations left without turns are members of the root. Other
    columns are not read.

    Conversations are cut into pieces of ``PIECE`` turns, and a turn's part of a prefix key depends on its place only,
    so a key is a running exclusive-or. Each task inserts batches of pieces into z-fast tries and expands their
    edges; equal nodes of several batches then meet in one aggregate, so a first turn that a third of all
    conversations share is one row per batch. A node belongs to its smallest member. The nodes that a conversation
    owns are the last ones of its path, hence each subtree's sum is the sum, over its members, of what they own in it:
    the same tries add it up in a second run. Prefix keys have 128 bits.
    """
    turns = numbered_turns(conversations, conv_column, turn_column, role_column, text_column)
    convs, pieces = rebuilt_pieces(turns, family, heads)
    whole = convs.agg(F.count("*").alias("n"), F.min("c").alias("conv")).first()
    spark = conversations.sparkSession
    schema = (
        "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
    )
    if not whole.n:
        return spark.createDataFrame([], schema)

    merged = tries(pieces.withColumn("n", F.lit(1).cast("bigint")), ["n"], "c").groupBy(*NODE).agg(
        *[F.min(x).alias(x) for x in ("pa", "pb", "size")], F.sum("n").alias("n"), F.min("c").alias("conv")
    )
    root = spark.range(1).select(
        *[F.lit(0).cast("bigint").alias(x) for x in [*NODE, "pa", "pb", "size"]], F.lit(whole.n).cast("bigint").alias("n"), F.lit(whole.conv).cast("bigint").alias("conv")
    )
    nodes = table(merged.unionByName(root), "trie-nodes")
    below = nodes.where("depth > 0")
    kids = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("fa"), F.col("pb").alias("fb")).agg(F.count("*").alias("kids"))
    nodes = table(
        nodes.join(kids, NODE, "left").withColumn("kids", F.coalesce("kids", F.lit(0))).withColumn("saved", (F.col("n") - 1) * F.col("size")), "trie-children"
    )

    owned = nodes.groupBy(F.col("conv").alias("c")).agg(F.sum("saved").alias("saved"), F.sum((F.col("kids") == 0).cast("bigint")).alias("leaves"))
    owned = table(owned.where("saved > 0 OR leaves > 0"), "trie-owned")
    shares = pieces.join(owned, "c", "left").withColumns({x: F.coalesce(x, F.lit(0)).cast("bigint") for x in ("saved", "leaves")})
    total = owned.agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).first()
    subtrees = tries(shares, ["saved", "leaves"]).select(*NODE, F.col("saved").alias("all_saved"), F.col("leaves").alias("all_leaves"))
    at_root = spark.range(1).select(
        *[F.lit(0).cast("bigint").alias(x) for x in NODE],
        *[F.lit(v or 0).cast("bigint").alias(n) for n, v in (("all_saved", total.saved if total else 0), ("all_leaves", total.leaves if total else 0))],
    )

    last = pieces.join(convs.select("c", "n_turns"), "c").where(F.col("base") + F.size("a") == F.col("n_turns"))
    ends = last.select(F.col("n_turns").alias("depth"), F.col("ea").alias("fa"), F.col("eb").alias("fb"), "c").unionByName(
        convs.where("n_turns = 0").select(*[F.lit(0).cast("bigint").alias(x) for x in NODE], "c")
    )
    before = running(nodes, "conv", "depth", {"before": ("sum", "saved")})
    # A parent is the node one turn above; the root's children need no join.
    up = below.select(*NODE, "conv").withColumnsRenamed({"depth": "up_depth", "fa": "pa", "fb": "pb", "conv": "parent"})
    deep = nodes.where("depth > 1").select(*NODE, "pa", "pb", (F.col("depth") - 1).alias("up_depth")).join(up, ["up_depth", "pa", "pb"])
    parents = deep.select(*NODE, "parent").unionByName(
        nodes.where("depth = 1").select(*NODE, F.lit(whole.conv).cast("bigint").alias("parent"))
    )
    parts = before.select(*NODE, "conv", "n", "kids", "before")
    for other in (parents, subtrees.unionByName(at_root), id_digests(ends)):
        parts = parts.unionByName(other, allowMissingColumns=True)
    return (
        parts.groupBy(*NODE)
        .agg(*[F.max(x).alias(x) for x in ("conv", "n", "kids", "before", "parent", "ends_sha256")], F.sum("all_saved").alias("saved"), F.sum("all_leaves").alias("leaves"))
        .select(
            F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
            F.col("leaves").alias("n_leaves"), (F.col("saved") - F.col("before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
