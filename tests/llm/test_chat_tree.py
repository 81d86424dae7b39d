"""The prefix tree of conversations against plain formatting."""

import random
from hashlib import sha256

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalwatch.llm import chat_tree as C

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string"


def formatted(turns):
    return "".join("".join(C.pieces(r, t)) for r, t in turns)


def conversations(rows):
    found, alone = {}, []
    for c, n, r, t in rows:
        if c is None:
            alone.append((None, [(r or "", t or "")]))
        else:
            found.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    return [(c, [(r, t) for *_, r, t in sorted(v)]) for c, v in found.items()] + alone


def plain(rows):
    out = []
    for c, turns in conversations(rows):
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((c, len(turns), sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest(),
                    len(formatted(turns))))
    return sorted(out, key=repr)


def tree_of(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns({c: F.lit("x") for c in ("conv", "k", "node", "ids", "part", "seq", "leaf")})
    return C.ChatTree(df, VOCABULARY)


def got(tree):
    rows = C.for_members(tree, C.read_back(tree)).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def check_stream(tree, rows):
    """Each shared turn once, depth first, gapless; reading a node's intervals gives its conversation."""
    nodes = sorted(tree.nodes.collect(), key=lambda r: (r.part, r.seq))
    stream, read = [], C.decoder(VOCABULARY)
    for r in nodes:
        assert r.start == len(stream) // 4 and r.tokens == len(r.ids) // 4 and r.position == sum(s.hi - s.lo for s in r.attends)
        assert all(a.hi < b.lo for a, b in zip(r.attends, r.attends[1:]))
        stream += r.ids
    prefixes = {tuple(turns[:k + 1]) for _, turns in conversations(rows) for k in range(len(turns))}
    assert len(nodes) == len(prefixes)
    texts = [read(bytes(b for s in r.attends for b in stream[4 * s.lo:4 * s.hi]) + bytes(r.ids)) for r in nodes]
    assert sorted(texts) == sorted(formatted(p) for p in prefixes)
    open_now = []
    for r, text in zip(nodes, texts):  # depth first: a node follows one that ends with its parent's branch
        del open_now[r.depth:]
        assert len(open_now) == r.depth and text.startswith(open_now[-1] if open_now else "")
        open_now.append(text)


def test_odd_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", None),
            (3, None, None, None), (3, 0, "assistant", ""), (4, 5, "user", "a <turn>b\n</turn>\nc\\l \\"), (4, 6, "assistant", "\\### Assistant: </turn> ok\\"),
            (5, 0, "user", "hi"), (5, 0, "user", "hi"), (6, 0, "odd\nrole <turn>", "x"), (None, 0, "user", "hi"), (None, 0, "user", "hi"),
            (7, 0, "user", "<|endoftext|> ### User: #### Assistant:"), (8, 0, "assistant", "long text, on and on " * 20000), (2, -1, "system", "日本 😀")]
    tree = tree_of(spark, rows)
    assert got(tree) == plain(rows)
    check_stream(tree, rows)
    assert got(tree_of(spark, rows[:1]).__class__(spark.createDataFrame([], SCHEMA), VOCABULARY)) == []


def test_a_large_tree_over_many_parts(spark):
    """Two thirds of the conversations share their first turns and 200 are copies; parts inherit open branches."""
    rng, rows = random.Random(4), []
    for c in range(900):
        n = rng.randrange(1, 7)
        said = ["start" if c % 3 else f"own {c}", *(rng.choice("ab") * 3 for _ in range(n))] if c >= 200 else ["start", "aaa", "bbb"]
        rows += [(c, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(said)]
    rows += [(2000 + c, k, "user", "deep") for c in range(30) for k in range(c)]  # prefixes of one long conversation
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tree = tree_of(spark, rows, 5)
        assert tree.nodes.select("part").distinct().count() > 2 and tree.inherited.count() > 0
        assert got(tree) == plain(rows)
        check_stream(tree, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from("a\\lhn\n<>/|#: turnUserAssistant"), max_size=12),
                          st.lists(st.sampled_from([*C.CONTROL, "\\", "\n", "x", "### ", "l", "turn>"]), max_size=6).map("".join)), max_size=4))
def test_escapes_are_undone(turns):
    text = formatted(turns)
    assert C.parsed(text) == turns
    for _, t in turns:
        assert not any(c in C.escape(t) for c in C.CONTROL) and C.unescape(C.escape(t)) == t
