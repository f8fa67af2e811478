"""SentencePiece, tool calls, automata, the graph and the pipeline."""

import json
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewright.llm.automata import infer, symbol
from tracewright.llm.bpe import Merges
from tracewright.llm.chat import canonical, fits, link_tool_calls
from tracewright.llm.common import Scratch
from tracewright.llm.graph import components
from tracewright.llm.pieces import decode_pieces, digests, encode_pieces, model, product
from tracewright.llm.queries import TOOLS, tokenizer


def unigram_model(path, pieces):
    """A model of type unigram with given pieces and scores: written, not trained."""

    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    def field(k, v):
        return varint(k << 3 | 2) + varint(len(v)) + v

    body = b""
    for text, score, kind in [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((p, s, 1) for p, s in pieces)]:
        body += field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + b"\x18" + varint(kind))
    body += field(2, b"\x18\x01") + field(3, field(1, b"identity") + b"\x18\x01\x20\x00")
    path.write_bytes(body)
    return str(path)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    rng = np.random.default_rng(2)
    pieces = ["▁", *"abcdef", "ab", "bc", "cde", "▁a", "▁ab", "abcab", "fed", "ef", "▁fe", "aa", "bb", "ccc", "deadbeef"]
    return unigram_model(tmp_path_factory.mktemp("m") / "u.model", [(p, -float(x)) for p, x in zip(pieces, rng.uniform(1, 9, len(pieces)))])


def giant_texts():
    rng = np.random.default_rng(8)
    make = lambda n, letters: "".join(rng.choice(list(letters), n))
    return [None, "", "a", " a  b ", make(900, "abcdef"), make(700, "abcdef   "), "a" * 400, make(300, "ab ") + "xyz" + make(300, "cdef"), "deadbeef" * 60]


def coded(frame):
    return {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in frame.collect()}


def test_max_plus_equals_the_library(spark, unigram):
    """Whatever the chunks, far smaller than the texts, the scan gives the library's unigram encoding."""
    texts = giant_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lib = model(unigram).library
    want = {k: lib.encode(t or "") for k, t in enumerate(texts)}
    for giant, chunk in ((100, 37), (10**6, 10**6), (200, 150)):
        got = encode_pieces(docs, unigram, giant=giant, chunk=chunk)
        assert coded(got) == want
    assert {r.doc_id: r.same for r in got.collect()} == {k: lib.decode(lib.encode(t or "")) == (t or "") for k, t in enumerate(texts)}
    assert encode_pieces(docs.where("false"), unigram).count() == 0


def test_ties_do_not_depend_on_chunks(spark, tmp_path):
    """Many segmentations of one score: of a run of one letter, and of pieces that add up."""
    path = unigram_model(tmp_path / "ties.model", [("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.5), ("ab", -2.5), ("ba", -2.5), ("aba", -3.5)])
    rng = np.random.default_rng(4)
    texts = ["a" * 1000, "".join(rng.choice(list("ab"), 800)), "".join(rng.choice(list("aab "), 900))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = coded(encode_pieces(docs, path, giant=10**6))
    assert [len(want[k]) > 100 for k in range(3)] == [True] * 3
    for chunk in (7, 100, 333):
        assert coded(encode_pieces(docs, path, giant=50, chunk=chunk)) == want


def test_transfer_matrices_compose(unigram):
    m = model(unigram)
    rng = np.random.default_rng(1)
    for alphabet in ("abcdef", "abcdef▁"):
        text = "▁" + "".join(rng.choice(list(alphabet), 120))
        cuts = [0, 30, 75, 121]
        parts = [m.transfer(text[a : b + m.longest - 1], b - a) for a, b in zip(cuts, cuts[1:])]
        left, right = product(product(parts[0], parts[1]), parts[2]), product(parts[0], product(parts[1], parts[2]))
        assert left[0, 0] == right[0, 0] == m.transfer(text, 121)[0, 0] == m.ahead(text, 121, [0])[0][121]


def odd_texts():
    rng = np.random.default_rng(9)
    some = ["Hello  world\n é ﬁ 中 𝔘 tab\t", " lead", "trail ", "\n", " ", "  \n\n x", "\r\n\x00 龘𠀀🙂", "it's 12.5% <|endoftext|> ok", "a <|startoftext|>", "word " * 500, "x" * 3000, "é" * 700 + " " * 300]
    return ["", None, *some, *("".join(rng.choice(list("aAbRst  \n.,'é1Ü中龘\t"), rng.integers(0, 90))) for _ in range(150))]


def test_bpe_model_equals_the_library(spark):
    """Texts of the character that stands for spaces, unknown characters and long units among them, in chunks of any size."""
    path = tokenizer("piece_bpe_32k.model")
    texts = [*odd_texts(), "▁ odd", "so ▁ many " * 90]
    docs = spark.createDataFrame([*enumerate(texts), (2, texts[2]), (7, "another text of the same id " * 30), (None, "no id " * 40), (None, "no id " * 40)], "doc_id long, text string").withColumn("tkey", F.lit("clash")).withColumn("k", F.lit(1)).repartition(4)
    lib = model(path).library
    want = sorted([(k, tuple(lib.encode(t or "")), lib.decode(lib.encode(t or "")) == (t or "")) for k, t in [*enumerate(texts), (2, texts[2]), (7, "another text of the same id " * 30), (None, "no id " * 40), (None, "no id " * 40)]], key=repr)
    for giant, chunk in ((10**6, 100), (50, 16), (300, 333)):
        enc = encode_pieces(docs, path, giant=giant, chunk=chunk)
        assert sorted([(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.same) for r in enc.collect()], key=repr) == want
    back = [(r.doc_id, r.text) for r in decode_pieces(enc, path).collect()]
    assert sorted(back, key=repr) == sorted([(k, lib.decode(list(ids))) for k, ids, _ in want], key=repr)
    digested = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in enc.mapInArrow(digests, "doc_id long, n_tokens long, ids_crc32 long, same boolean").collect()}
    assert digested[3] == (len(lib.encode(texts[3])), zlib.crc32(np.array(lib.encode(texts[3]), "<u4").tobytes())) and digested[0] == (0, 0)
    assert encode_pieces(docs.where("false"), path).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    """Also special tokens' strings, which the library's plain call takes as one id."""
    from tokenizers import Tokenizer

    from tracewright.llm.tokens import Encoder

    lib, mine = Tokenizer.from_file(tokenizer(name)), Encoder(tokenizer(name))
    texts = [*odd_texts(), "it's's 's --'ll", "ÀÉ ÿŸ İſ µªº²½ «x» ¿Qué?", "Σς ΑΣ", "a\u0085b\u00a0c\u200bd", "a <|endoftext|> b"]
    assert mine.shape and [x.tolist() for x in mine.texts(pa.array(texts, pa.string()))] == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert mine.encode("a <|endoftext|> b").tolist().count(lib.token_to_id("<|endoftext|>")) == 1
    mine.shape = None
    assert [x.tolist() for x in mine.texts(pa.array(texts, pa.string()))] == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_merges_equal_one_word_at_a_time():
    rng = np.random.default_rng(0)
    left, right = (rng.integers(0, 12, 60) for _ in range(2))
    pairs = {p: k for k, p in enumerate(zip(left.tolist(), right.tolist()))}
    pairs = {p: (k // 3, 5 + k % 9) for p, k in pairs.items()}  # several pairs of one order
    merges = Merges([a for a, _ in pairs], [b for _, b in pairs], [o for o, _ in pairs.values()], [r for _, r in pairs.values()])
    words = [rng.integers(0, 12, rng.integers(1, 30)).tolist() for _ in range(500)]
    flat, at = merges.merged(np.array([x for w in words for x in w], np.int32), np.append(0, np.cumsum([len(w) for w in words])))
    for k, w in enumerate(words):
        while found := [(pairs[p][0], i) for i, p in enumerate(zip(w, w[1:])) if p in pairs]:
            i = min(found)[1]
            w[i : i + 2] = [pairs[w[i], w[i + 1]][1]]
        assert flat[at[k] : at[k + 1]].tolist() == w


def call(k, name, args):
    return f"<tool_call>{json.dumps({'id': k, 'name': name, 'arguments': args})}</tool_call>"


def answer(k, content):
    return f"<tool_result>{json.dumps({'id': k, 'content': content})}</tool_result>"


def test_tool_calls(spark):
    turns = [
        (1, 0, "user", "find it"),
        (1, 1, "assistant", "ok " + call("c", "calculate", {"expression": {"$ref": "b"}}) + call("b", "fetch", {"url": {"$ref": "a"}}) + call("a", "search", {"query": "é", "limit": 3})),
        (1, 2, "tool", answer("a", {"z": 1, "b": [2]}) + answer("b", "page") + answer("q", "lost")),
        (1, 3, "assistant", call("a", "search", {"query": "again"}) + call("d", "search", {"limit": "x"}) + call("e", "nothing", {}) + "<tool_call>no json</tool_call>"),
        (2, 0, "assistant", call("x", "fetch", {"url": {"$ref": "y"}}) + call("y", "fetch", {"url": {"$ref": "x"}})),
        (2, 1, None, None),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("level", F.lit("clash"))
    out = link_tool_calls(df, TOOLS).collect()
    calls = {(r.conv_id, r.turn, r.call_id): (r.level, r.status) for r in out if r.kind == "call"}
    assert calls == {(1, 1, "a"): (0, "valid"), (1, 1, "b"): (1, "valid"), (1, 1, "c"): (2, "unanswered"), (1, 3, "a"): (0, "unanswered"), (1, 3, "d"): (0, "invalid"), (1, 3, "e"): (0, "unknown"), (1, 3, None): (None, "malformed"), (2, 0, "x"): (None, "unanswered"), (2, 0, "y"): (None, "unanswered")}
    assert [r.call_id for r in out if r.kind == "result"] == ["q"]
    one = next(r for r in out if r.call_id == "a" and r.turn == 1)
    assert one.json == '{"arguments":{"limit":3,"query":"é"},"id":"a","name":"search","result":{"b":[2],"z":1},"role":"tool_call"}'
    assert sorted((r.conv_id, r.turn, json.loads(r.json)["content"]) for r in out if r.kind == "message")[:2] == [(1, 0, "find it"), (1, 1, "ok")]
    assert link_tool_calls(df.where("false")).count() == 0


def test_tool_calls_of_odd_json(spark):
    """Half surrogates, deep nesting, numbers that are not JSON, nulls everywhere, and repeated rows, of which the first alone is linked."""
    odd = ['"\\ud800"', "[" * 100_000, "NaN", "1e999", "-Infinity", "9" * 5000, '{"a":1e5}']
    body = lambda k, x: f'<tool_call>{{"id":"{k}","name":"search","arguments":{{"query":"q","x":{x}}}}}</tool_call>'
    turns = [(1, k, "assistant", body(f"o{k}", x)) for k, x in enumerate(odd)]
    turns += [(2, 0, "assistant", call("a", "search", {"query": "q"}))] * 3 + [(2, 1, "tool", answer("a", "r"))] * 2
    turns += [(3, 0, "assistant", call("a", "search", {"query": "1"})), (3, 0, "assistant", call("a", "search", {"query": "2"})), (3, 0, None, answer("a", "\ud83d\ude00")), (None, None, None, None), (None, None, "user", call("n", "search", {})), (None, 1, "tool", answer("n", None))]
    out = link_tool_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3), TOOLS).collect()
    status = lambda c: sorted((r.turn, r.status) for r in out if r.conv_id == c and r.kind != "message")
    assert [r.status for r in sorted((r for r in out if r.conv_id == 1 and r.kind == "call"), key=lambda r: r.turn)] == ["unanswered", *["malformed"] * 5, "unanswered"]
    assert '\\ud800' in next(r.json for r in out if r.conv_id == 1 and r.turn == 0 and r.kind == "call")
    assert status(2) == [(0, "unanswered"), (0, "unanswered"), (0, "valid"), (1, "orphan")]
    assert status(3) == [(0, "unanswered"), (0, "valid")]
    one = json.loads(next(r.json for r in out if r.conv_id == 3 and r.status == "valid"))
    assert one["arguments"] == {"query": "1"} and one["result"] == "😀"
    assert sorted((r.status, r.call_id) for r in out if r.conv_id is None and r.kind != "message") == [("invalid", "n")]
    assert sum(r.kind == "message" for r in out) == len(turns)
    for r in out:
        json.loads(r.json, parse_constant=lambda x: pytest.fail(x))


def test_levels_of_calls(spark):
    """Chains, cycles with calls that lead into them, and calls of many references, against a plain search."""
    rng = np.random.default_rng(14)
    refs = {("chain", k): [k - 1] if k else [] for k in range(40)}
    refs |= {("both", k): [k - 1, 0] if k > 1 else [0] * k for k in range(20)}
    refs |= {("cycle", k): [(k + 1) % 5] for k in range(5)} | {("cycle", 5): [2], ("cycle", 6): [5, 7], ("cycle", 7): [], ("cycle", 8): [8]}
    refs |= {(None, k): [x for x in range(k) if rng.random() < 0.15] for k in range(30)}
    refs |= {("tangle", k): [int(x) for x in set(rng.integers(0, 40, int(rng.integers(0, 3))))] for k in range(30)}

    def level(c, k, path=()):
        if k in path:
            return None
        below = [level(c, x, (*path, k)) for x in refs[c, k] if (c, x) in refs]
        return None if None in below else max(below, default=-1) + 1

    rows = [(c, k, "assistant", call(f"i{k}", "search", {"query": "q", "of": [{"$ref": f"i{x}"} for x in own]})) for (c, k), own in refs.items()]
    out = link_tool_calls(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(3), TOOLS)
    got = {(r.conv_id, r.turn): r.level for r in out.where("kind = 'call'").collect()}
    assert got == {(c, k): level(c, k) for c, k in refs}


def test_schema_checks():
    s = {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer"}, "b": {"type": "array", "items": {"enum": [1, 2]}}}, "additionalProperties": False}
    assert fits({"a": 1, "b": [2]}, s) and not fits({"a": True}, s) and not fits({"b": []}, s) and not fits({"a": 1, "c": 1}, s) and not fits({"a": 1, "b": [3]}, s)
    assert canonical({"b": 1, "a": "é\n"}) == '{"a":"é\\n","b":1}'


def test_automaton_prefers_its_format():
    rng = np.random.default_rng(0)
    a = infer(["k-" + "".join(rng.choice(list("0123456789"), 10)) for _ in range(200)])
    score = lambda x: a.score([symbol(c) for c in x], 12)
    assert len(a.next) < 20 and score("k-0099887766") > score("k-00aa887766") > score("hello-worlds")


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(1, 80)] + [(int(a), int(b)) for a, b in rng.integers(200, 260, (40, 2))]
    up = defaultdict(lambda: None)

    def root(x):
        while up[x] is not None:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()}
    assert got == {n: root(n) for e in edges for n in e if root(n) != n}


def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline as P

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    sizes = []
    for k, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()} if k < 5 else {}
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == P.COLUMNS, name
            after = {r.doc_id: r.text for r in docs.collect()}
            assert set(after) <= set(before)
            if k in (0, 2):
                assert all(after[i] == before[i] for i in after)
        sizes.append(docs.count())
    assert sizes[0] < 200 and sizes[3] == sizes[2] and docs.select("doc_id").distinct().count() == sizes[3]
    again = P.run(spark, d)
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(again) == key(docs)


def test_pipeline_keeps_one_of_many_copies(spark, tmp_path):
    import corpus_pipeline as P

    rng = np.random.default_rng(8)
    say = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))
    copied = "\n".join(say(20) for _ in range(3))
    texts = [copied if k % 2 else say(40) for k in range(24)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k == 3:
            assert {r.doc_id: r.text for r in docs.collect()} == {i: texts[i] for i in [1, *range(0, 24, 2)]}
    assert {r.doc_id for r in docs.collect()} == {1, *range(0, 24, 2)}


def test_queries_are_registered():
    import __spark_entry__ as e

    names = e.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)) and "pipeline" in names
