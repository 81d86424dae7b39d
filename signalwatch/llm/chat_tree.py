r"""Chat formatting as a prefix tree of conversations.

Every turn is one marked piece of text: ``<turn>role``, a line break, the text,
``</turn>`` and a line break. Within roles and texts a backslash is doubled and the first
character of a control string becomes a backslash and a letter, so a mark never
occurs inside a text, cutting at the marks reads the turns back, and the texts come
back as they were. Text under the loss mask is that of the assistant's turns alone.

Conversations that begin with the same turns share them: a node is a turn after given
turns before it (a hash chained from turn to turn names it). Each node's tokens are
emitted once, depth first, in one stream. A node carries its place in the stream
(``start``), the position id of its first token (as if its conversation stood alone)
and the stream's intervals of its ancestors, which its tokens attend to besides the
earlier ones of their own node; neighbouring intervals are one.

How it runs.

1. Rows are dealt by conversation and sorted by turn; one streaming pass formats and
   tokenises each turn and chains the hashes. A conversation's turns are never held
   together, only 20 bytes for each.
2. Nodes with the same hash are one row (combined before the shuffle), and so are
   conversations with the same path. Paths are range-sorted: a path's key is the row of
   its nodes' hashes, so sorted paths run through the tree depth first, and a tree
   that holds most conversations is spread over many tasks.
3. Each sorted part lists its nodes in order; those that the part before ended with
   are inherited, all others are its own. Places in the stream are sums over the parts.
4. One pass over each part, with the current path as a stack, gives position ids and
   intervals. The stream is read back in the same way.

Defined cases: a null text or role is empty; each row without a conversation id is a
conversation of its own; turns are sorted by turn (null first), then role and text, so
a repeated turn stays as a turn of its own; an empty table gives no nodes; other
columns are ignored. A conversation is one sequence, so one task reads all its rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalwatch.llm.common import worker_cache
from signalwatch.llm.packing import Stream
from signalwatch.session import RunFolder

BEGIN, END = "<turn>", "</turn>"
#: Strings that templates and tokenizers take as marks; none is left inside a formatted text.
CONTROL = (BEGIN, END, "### Assistant:", "### User:", "### System:", "<|")
HIDDEN = {"<": "l", "#": "h", "\n": "n", "\\": "\\"}
SHOWN = {v: k for k, v in HIDDEN.items()}
controls = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
escaped = re.compile(r"\\(.)", re.S)
marked = re.compile(re.escape(BEGIN) + "(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)
#: Bytes of a node's hash.
HASH = 16


def escape(text: str) -> str:
    return controls.sub(lambda m: "\\" + HIDDEN[m[0][0]] + m[0][1:], text)


def unescape(text: str) -> str:
    return escaped.sub(lambda m: SHOWN[m[1]], text)


def pieces(role: str, text: str) -> tuple[str, str, str]:
    """The formatted turn: what stands before the text, the text, and what stands behind it."""
    return f"{BEGIN}{escape(role).replace(chr(10), chr(92) + 'n')}\n", escape(text), f"{END}\n"


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    return [(unescape(a), unescape(b)) for a, b in marked.findall(formatted)]


def chained(before: bytes, role: str, text: str) -> bytes:
    """The node of a turn after the node before it."""
    r = role.encode()
    return blake2b(before + len(r).to_bytes(8, "big") + r + text.encode(), digest_size=HASH).digest()


def stream_of(path: str) -> Stream:
    return worker_cache(f"stream {path}", lambda: Stream(path))


def decoder(path: str):
    """Token ids (little-endian unsigned 32-bit) to text."""
    s = stream_of(path)
    return lambda ids: s.fast.decode_bytes(np.frombuffer(ids, "<u4").tolist()).decode()


def formatted_turns(rows: DataFrame, vocabulary: str) -> DataFrame:
    """conv, turn number, node, role, ids, tokens and the tokens under the loss mask of every row, in the order of the conversations."""
    sorted_rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    kinds = [pa.binary(), pa.int32(), pa.binary(), pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches):
        tokens, now, k, node = stream_of(vocabulary), None, 0, b""
        for b in batches:
            for lo in range(0, len(b), 256):
                part, out = b.slice(lo, 256), []
                for conv, role, text in zip(*(part.column(c).to_pylist() for c in range(3))):
                    if conv != now:
                        now, k, node = conv, 0, b""
                    node = chained(node, role, text)
                    head, body, tail = (tokens.ids(x) for x in pieces(role, text))
                    ids = np.concatenate([head, body, tail]).astype("<u4")
                    lo_, hi = (len(head), len(head) + len(body)) if role == "assistant" else (0, 0)
                    out.append((conv, k, node, role, ids.tobytes(), len(ids), lo_, hi))
                    k += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)],
                                                 ["conv", "k", "node", "role", "ids", "tokens", "loss_from", "loss_to"])

    return sorted_rows.mapInArrow(run, "conv binary, k int, node binary, role string, ids binary, tokens int, loss_from int, loss_to int")


def by_group(batches) -> Iterator[tuple]:
    """(is it the first of its group, row) of sorted Arrow rows; the group is the first column."""
    now = None
    for b in batches:
        for lo in range(0, len(b), 256):
            part = b.slice(lo, 256)
            for r in zip(*(part.column(c).to_pylist() for c in range(part.num_columns))):
                yield r[0] != now, r
                now = r[0]


def batched(rows: Iterator[tuple], names: list[str], kinds: list, size: int = 2000) -> Iterator[pa.RecordBatch]:
    out = []
    for r in rows:
        out.append(r)
        if len(out) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)


def paths_of(turns: DataFrame) -> DataFrame:
    """conv, key (the hashes of its nodes end to end), sizes (tokens of each) and leaf, one row for each conversation.

    ``turns`` is dealt by conversation again; 20 bytes of a turn are moved.
    """
    rows = turns.select("conv", "k", "node", "tokens").repartition("conv").sortWithinPartitions("conv", "k")

    def run(batches):
        def found():
            conv, key, sizes = None, bytearray(), []
            for new, (c, _, node, tokens) in by_group(batches):
                if new and sizes:
                    yield conv, bytes(key), sizes, bytes(key[-HASH:])
                    key, sizes = bytearray(), []
                conv = c
                key += node
                sizes.append(tokens)
            if sizes:
                yield conv, bytes(key), sizes, bytes(key[-HASH:])
        yield from batched(found(), ["conv", "key", "sizes", "leaf"], [pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.binary()], 500)

    return rows.mapInArrow(run, "conv binary, key binary, sizes array<int>, leaf binary")


def nodes_in_order(paths: DataFrame) -> DataFrame:
    """part, seq, k, node, tokens: the nodes that each sorted part of paths meets, depth first, each once for the part."""
    rows = paths.repartition("part").sortWithinPartitions("part", "key").select("part", "key", "sizes")

    def run(batches):
        def found():
            last, seq = b"", 0
            for new, (part, key, sizes) in by_group(batches):
                if new:
                    last, seq = b"", 0
                n, same = len(sizes), 0
                while same < n and key[same * HASH:(same + 1) * HASH] == last[same * HASH:(same + 1) * HASH]:
                    same += 1
                for k in range(same, n):
                    yield part, seq, k, key[k * HASH:(k + 1) * HASH], sizes[k]
                    seq += 1
                last = key
        yield from batched(found(), ["part", "seq", "k", "node", "tokens"], [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32()])

    return rows.mapInArrow(run, "part int, seq long, k int, node binary, tokens int")


def attended(rows: DataFrame) -> DataFrame:
    """Adds position (of the first token) and attends (the ancestors' intervals of the stream) to part, seq, k, node, tokens, start, own."""
    rows = rows.select("part", "seq", "k", "node", "tokens", "start", "own").repartition("part").sortWithinPartitions("part", "seq")
    span = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])

    def run(batches):
        def found():
            path: list[tuple[int, list]] = [(0, [])]  # for each depth: tokens before it, intervals of its ancestors
            for _, (part, seq, k, node, tokens, start, own) in by_group(batches):
                del path[k + 1:]
                before, spans = path[k]
                if own:
                    yield node, part, seq, k, start, before, [{"lo": a, "hi": b} for a, b in spans]
                if spans and spans[-1][1] == start:
                    spans = [*spans[:-1], (spans[-1][0], start + tokens)]
                else:
                    spans = [*spans, (start, start + tokens)]
                path.append((before + tokens, spans))
        yield from batched(found(), ["node", "part", "seq", "depth", "start", "position", "attends"],
                           [pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(span)])

    return rows.mapInArrow(run, "node binary, part int, seq long, depth int, start long, position long, attends array<struct<lo:long,hi:long>>")


class ChatTree:
    """The formatted conversations.

    ``nodes``: one row for each turn after given turns before it, in the order (part, seq) of the stream: node, depth,
    role, ids, tokens, loss_from and loss_to (tokens under the loss mask), start, position, attends.
    ``members``: conv_id and the leaf, the last node, of every conversation.
    ``inherited``: the nodes of earlier parts that a part's nodes stand on (part, seq, k, node).
    """

    def __init__(self, conversations: DataFrame, vocabulary: str, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        self.vocabulary, self.folder = vocabulary, RunFolder(conversations.sparkSession)
        keep, c = self.folder.keep, conversations
        cid = c[key].cast("long")
        alone = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))
        rows = c.select(F.coalesce(F.concat(F.lit("id "), cid.cast("string")), alone).cast("binary").alias("conv"), c[turn].cast("long").alias("turn"),
                        F.coalesce(c[role], F.lit("")).alias("role"), F.coalesce(c[text], F.lit("")).alias("text"))
        turns = keep(formatted_turns(rows, vocabulary), "turns")
        found = keep(paths_of(turns), "found")
        name = F.col("conv").cast("string")
        self.members = found.select(F.when(name.startswith("id "), F.substring(name, 4, 30).cast("long")).alias("conv_id"), "leaf")
        distinct = found.groupBy("leaf").agg(F.min("key").alias("key"), F.min("sizes").alias("sizes"))
        distinct = distinct.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id())
        paths = keep(distinct, "paths")
        order = keep(nodes_in_order(paths), "order")
        # the last path of the part before, as nodes that a part inherits
        ends = paths.groupBy("part").agg(F.max("key").alias("key"))
        ends = ends.select("part", F.lag("key").over(Window.orderBy("part")).alias("key")).filter("key is not null")  # a row for each part
        places = F.sequence(F.lit(1), F.length("key"), F.lit(HASH))
        ends = ends.select("part", F.explode(F.transform(places, lambda k: F.substring(F.col("key"), k, F.lit(HASH)))).alias("node"))
        order = order.join(ends.withColumn("old", F.lit(True)), ["part", "node"], "left").withColumn("own", F.col("old").isNull()).drop("old")
        order = keep(order, "owned")
        sums = order.filter("own").groupBy("part").agg(F.sum("tokens").alias("all"))
        before = F.sum("all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each part
        sums = sums.select("part", F.coalesce(before, F.lit(0)).alias("before"))
        inside = F.sum("tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
        own = order.filter("own").join(sums, "part").withColumn("start", F.col("before") + F.coalesce(inside, F.lit(0))).drop("before")
        own = keep(own, "own")
        self.inherited = order.filter("not own").select("part", "seq", "k", "node")
        old = order.filter("not own").join(own.select("node", "start"), "node")
        spans = keep(attended(own.unionByName(old.select(own.columns))), "attended")
        node_rows = turns.groupBy("node").agg(F.first(F.struct("role", "ids", "tokens", "loss_from", "loss_to")).alias("r")).select("node", "r.*")
        self.nodes = keep(spans.join(node_rows, "node"), "nodes")


def read_back(tree: ChatTree) -> DataFrame:
    """leaf, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of every distinct conversation, read from the
    stream: a pass over each part decodes every node and carries the digests of the current path on a stack."""
    cols = ["node", "ids", "loss_from", "loss_to"]
    rows = tree.nodes.select("part", "seq", F.col("depth").alias("k"), *cols)
    old = tree.inherited.join(tree.nodes.select(*cols), "node").select(rows.columns)
    rows = rows.unionByName(old).repartition("part").sortWithinPartitions("part", "seq")
    vocabulary = tree.vocabulary

    def run(batches):
        text_of = decoder(vocabulary)

        def found():
            stack: list[tuple] = [(0, sha256(), 0, sha256(), 0)]
            for _, (_, _, k, node, ids, lo, hi) in by_group(batches):
                del stack[k + 1:]
                n, turns, loss_chars, loss, chars = stack[k]
                text = text_of(ids)
                turns, loss = turns.copy(), loss.copy()
                for role, said in parsed(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                under = unescape(text_of(ids[4 * lo:4 * hi]))
                loss.update(under.encode())
                stack.append((n, turns, loss_chars + len(under), loss, chars + len(text)))
                n, turns, loss_chars, loss, chars = stack[-1]
                yield node, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars
        yield from batched(found(), ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
                           [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])

    return rows.mapInArrow(run, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def for_members(tree: ChatTree, leaves: DataFrame) -> DataFrame:
    """The rows of ``leaves`` for every conversation. Leaves of more than a thousandth of all conversations, a thousand at
    most, are sent to all tasks; no other leaf has more rows than that in one place."""
    counts = tree.folder.keep(tree.members.groupBy("leaf").agg(F.count("*").alias("copies")), "copies")
    total = counts.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]
    hot = counts.filter(F.col("copies") * 1000 > total).select("leaf")
    rows = tree.folder.keep(leaves.join(counts.select("leaf"), "leaf", "left_semi").dropDuplicates(["leaf"]), "read")
    hot_rows = tree.folder.keep(rows.join(hot, "leaf", "left_semi"), "hot")
    many = tree.members.join(F.broadcast(hot_rows), "leaf")
    few = tree.members.join(F.broadcast(hot_rows.select("leaf")), "leaf", "left_anti").join(rows, "leaf")
    return many.unionByName(few)
