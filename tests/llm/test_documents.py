"""The document operators against brute force, on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import near
from tracewright.llm.exact import exact_duplicates
from tracewright.llm.lines import drop_lines, keep_bitmaps, unpack
from tracewright.llm.near import near_duplicates
from tracewright.llm.packing import best_fit, pack, packed_sequences, slots, swap_search
from tracewright.llm.passages import drop_passages
from tracewright.llm.quality import quality_rules
from tracewright.llm.queries import tokenizer
from tracewright.llm.secrets import digested, find_secrets, mask
from tracewright.llm.sstable import Reader, Writer, int_key
from tracewright.llm.token_files import lookup, read_tokens, write_tokens

WS = r"[\x20\x09-\x0D]"
SCHEMA = "doc_id long, text string, lang string, source string, id long, tkey long, key string, name string, n int, h int"


def texts():
    rng = np.random.default_rng(11)
    words = ["Ba", "co", "dü", "éf", "go", "hi", "ji", "ko", "lu", "mé", "nö", "pi", "ra", "su", "ti", "vu"]
    say = lambda n: " ".join("".join(rng.choice(words, rng.integers(1, 4))) for _ in range(n))
    base = say(120)
    out = [None, "", " \t\n", "a", "A", "one two", "one\x0btwo", "\n\n", "x" * 500, "ab" * 300, "the same words again " * 60]
    first = base.split(" ")
    for k in range(30):
        w = list(first)
        for p in rng.choice(len(w), k % 5, replace=False):
            w[p] = say(1)
        out.append(" ".join(w))
    out += [base, base.upper(), base.replace(" ", "\n"), base.replace(" ", "  ")]
    shared = ["Shared line of text", "  shared LINE of text\t", say(45)]
    out += ["\n".join([say(12), shared[k % 2], shared[2], say(9)]) for k in range(14)]
    out += [say(3000), "key: " + "0123456789abcdef" * 3 + " end", "AKIA" + "B" * 16 + " password = 'hunter2hunter2' Token:short secret=\"abcdefgh12\"", say(30) + " ### $$$ %%% &&& " * 9]
    return out


@pytest.fixture(scope="module")
def rows():
    return [(k, t, ["en", "de", None][k % 3], f"s{k % 2}", 7, 8, "k", "nm", 1, 2) for k, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k):
    w = re.findall(rf"[^{WS[1:]}+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


@pytest.mark.parametrize("words,num,small", [(3, 85, False), (5, 80, False), (1, 60, True)])
def test_near_duplicates(docs, rows, words, num, small, monkeypatch):
    if small:  # many rounds of few partners, in several tasks a bucket
        for name, value in (("BLOCK", 5), ("DEALT", 4), ("PARTNERS", (1, 2, 2**31 - 1))):
            monkeypatch.setattr(near, name, value)
    sets = {r[0]: shingles(r[1], words) for r in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(docs, words=words, num=num).collect()}
    assert got == {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def test_parity_sketches_lose_no_link():
    rng = np.random.default_rng(3)
    for size in (1, 7, 200, 5000):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        for own in (0, size // 20, size // 8, size // 2):
            b = np.concatenate([a[own:], rng.integers(0, 2**63, own // 2, dtype=np.uint64)])
            x, y = (near.parities(s).view(np.uint64)[None] for s in (a, b))
            common = size - own
            linked = 100 * common >= 85 * (len(a) + len(b) - common)
            may = near.possible(np.array([len(a)]), np.array([len(b)]), x, y, 85, 100)[0]
            assert may or not linked
            assert size > 200 or own < size // 2 or size == 1 or not may


def test_near_duplicates_of_odd_rows(spark, none):
    odd = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "z"), (2, None)], "doc_id long, text string")
    got = sorted(near_duplicates(odd).collect(), key=repr)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(1, 1, True), (1, 1, True), (2, 2, True)]
    assert sorted(((r.component_id, r.kept) for r in got if r.doc_id is None), key=repr) == [(1, False), (None, True)]
    assert near_duplicates(none).count() == 0


def test_lines(docs, rows, none):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\v\f\r"))
    for least, chars in ((10, 1), (2, 1), (3, 12)):
        seen = Counter()
        for r in rows:
            seen.update({k for k in map(key, (r[1] or "").split("\n")) if len(k) >= chars})
        want = {}
        for r in rows:
            lines = (r[1] or "").split("\n")
            kept = [x for x in lines if not (len(key(x)) >= chars and seen[key(x)] >= least)]
            want[r[0]] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
        got = drop_lines(docs, keep_bitmaps(docs, min_docs=least, min_chars=chars), with_text=False)
        assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    text = drop_lines(docs, keep_bitmaps(docs, min_docs=10))
    assert set(SCHEMA.replace(",", "").split()[::2]) - {"n_lines"} <= set(text.columns)
    assert drop_lines(none, keep_bitmaps(none)).count() == 0


def test_first_lines_stay(spark):
    d = spark.createDataFrame([(k, "x\nrepeat\nrepeat" if k else "repeat\ny") for k in range(6)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in drop_lines(d, keep_bitmaps(d, min_docs=2, keep_first=True)).collect()}
    assert got[0] == "repeat\ny" and got[1] == "x" and got[2] == ""
    bits = {r.id: unpack(r.keep).tolist() for r in keep_bitmaps(d, min_docs=2).collect()}
    assert bits[3] == [False, False, False] and bits[0] == [False]


@pytest.mark.parametrize("block", [4096, 7])
def test_exact(docs, rows, none, block):
    groups = defaultdict(list)
    norm = {r[0]: re.sub(WS, "", r[1] or "") for r in rows}
    for r in rows:
        groups[norm[r[0]]].append((-len(r[1] or ""), r[0]))
    want = {i: (min(groups[t])[1], len(groups[t]), min(groups[t])[1] == i, hashlib.sha256(t.encode()).hexdigest()) for i, t in norm.items()}
    assert {r[0]: tuple(r[1:]) for r in exact_duplicates(docs, block=block).collect()} == want
    assert exact_duplicates(none).count() == 0


def test_exact_repeated_rows(spark):
    d = spark.createDataFrame([(1, "abcdefghij" * 3)] * 3 + [(2, "x"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(d, block=4).collect()), key=repr)
    assert got == [(1, 1, 3, True)] * 3 + [(2, 2, 1, True), (None, None, 1, True)]


def test_quality(docs, rows, none):
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert len(got) == len(rows)
    for r in rows:
        t = r[1] or ""
        w = re.findall(rf"[^{WS[1:]}+", t)
        lines = [x for x in t.split("\n") if re.search(rf"[^{WS[1:]}", x)]
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        seen, cover = Counter(grams), set()
        for k, g in enumerate(grams):
            if seen[g] > 1:
                cover.update(range(k, k + 5))
        x = got[r[0]]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))
        assert x.base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
        assert not (x.base_failed and x.kept)
    assert quality_rules(none).count() == 0


def test_quality_thresholds_follow_the_group(spark):
    """A share of symbols that is usual for its source stays, and goes where it is not."""
    clean, odd = "word and more words of a usual length here " * 4, "word### and### more*** words$$$ of%%% a&&& usual### length here " * 4
    rows = [(k, f"{clean} u{k}", "en", "plain") for k in range(300)] + [(1000 + k, f"{odd} u{k}", "en", "code") for k in range(300)] + [(5000, odd + "once", "en", "plain")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), repeat_share=100).collect()}
    assert got[5000].odd_symbols and not got[5000].kept and not got[3].odd_symbols and not got[1003].odd_symbols


def test_quality_thresholds_of_repeats(spark):
    """Below the base cutoff, repeated words or lines go where their source has none and stay where it has many."""
    say = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    phrases = lambda k: f"{say(k, 162)} {say(-k, 19)} and {say(-k, 19)}"
    lines = lambda k: "\n".join([say(k, 90), *["again"] * 4, *[say(k * 100 + j, 8) for j in range(10)]])
    rows = [(k, say(k, 200), "en", "plain") for k in range(1, 300)] + [(1000 + k, (phrases if k % 2 else lines)(k), "en", "much") for k in range(1, 300)]
    rows += [(5000, phrases(7000), "en", "plain"), (5001, lines(7001), "en", "plain")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(r.base_failed for r in got.values())
    names = ["symbols", "dup_lines", "repeats", "word_length"]
    odd = lambda i: [m for m in names if got[i][f"odd_{m}"]]
    assert odd(5000) == ["repeats"] and odd(5001) == ["dup_lines"]
    assert odd(1001) == odd(1002) == odd(5) == [] and got[1001].kept and not got[5000].kept and not got[5001].kept


def test_quality_word_length_has_no_ceiling(spark):
    """Words too long for their source go, even where its usual ones have over 10 characters."""
    say = lambda k, n: " ".join(f"{k:04d}{i:04d}".ljust(n, "x") for i in range(50))
    rows = [(k, say(k, 12 + k % 3), "en", "long") for k in range(300)] + [(1000 + k, say(1000 + k, 8), "en", "short") for k in range(300)]
    rows += [(5000, say(5000, 100), "en", "long"), (5001, say(5001, 13), "en", "long"), (5002, say(5002, 100), "en", "short")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [i for i in got if got[i].odd_word_length] == [i for i in got if not got[i].kept]
    assert {i for i in got if not got[i].kept} == {5000, 5002}


def test_passages(docs, rows, none):
    raw = {r[0]: (r[1] or "").encode() for r in rows}
    seen = Counter(x[k : k + 200] for x in raw.values() for k in range(len(x) - 199))
    want = {}
    for i, x in raw.items():
        gone = np.zeros(len(x) + 1, bool)
        for k in range(len(x) - 199):
            if seen[x[k : k + 200]] > 1:
                gone[k : k + 200] = True
        want[i] = (len(x), int(gone.sum()), int((np.diff(np.append(False, gone).astype(int)) == 1).sum()), hashlib.sha256(bytes(b for b, g in zip(x, gone) if not g)).hexdigest())
    assert {r[0]: tuple(r[1:]) for r in drop_passages(docs, digest=True).collect()} == want
    assert drop_passages(none).count() == 0


def test_passages_of_long_documents_in_pieces(spark, monkeypatch):
    import tracewright.llm.passages as P

    rng = np.random.default_rng(3)
    letters = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()
    part = letters(700)
    text = letters(3000) + part + letters(2500) + part + letters(900)
    monkeypatch.setattr(P, "PIECE", 1000)
    arrow = __import__("pyarrow")
    batch = arrow.RecordBatch.from_pydict({"id": [1], "tkey": [2], "text": [text]})
    got = arrow.Table.from_batches(list(P.phrases(200)([batch]))).to_pydict()
    starts = sorted((p >> 32) + k for p in got["place"] for k in range((p & 0xFFFF) + 1))
    assert starts == list(range(len(text) - 199))
    d = spark.createDataFrame([(1, text), (1, text[50:900]), (2, text[2900:3400] + "é" * 300), (2, "é" * 200), (None, "é" * 150 + text[:300]), (None, None)], "doc_id long, text string").withColumn("tkey", F.lit(1)).withColumn("g", F.lit(2)).repartition(3)
    rows = [tuple(r)[:2] for r in d.collect()]
    assert sorted(map(tuple, drop_passages(d, digest=True).collect()), key=repr) == sorted(passages_by_force(rows), key=repr)


def passages_by_force(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(x[k : k + 200] for _, x in raw for k in range(len(x) - 199))
    for i, x in raw:
        gone = np.zeros(len(x) + 1, bool)
        for k in range(len(x) - 199):
            if seen[x[k : k + 200]] > 1:
                gone[k : k + 200] = True
        yield i, len(x), int(gone.sum()), int((np.diff(np.append(False, gone).astype(int)) == 1).sum()), hashlib.sha256(bytes(b for b, g in zip(x, gone) if not g)).hexdigest()


@pytest.mark.parametrize("forms", [4096, 3])
def test_passages_that_differ_around(spark, monkeypatch, forms):
    """Passages of many lengths in many surroundings, repeated rows and ids, runs of one letter and of zeros, and triggers of more phrases than one task sorts."""
    import tracewright.llm.passages as P

    monkeypatch.setattr(P, "FORMS", forms)
    monkeypatch.setattr(P, "TOGETHER", 20_000)
    rng = np.random.default_rng(5)
    say = lambda n: "".join(rng.choice(list("abcdefghij \né\0"), n))
    shared = [say(int(n)) for n in rng.integers(120, 420, 12)]
    rows = [(k, say(int(rng.integers(0, 150))) + "".join(shared[i] + say(int(rng.integers(0, 90))) for i in rng.integers(0, 12, 3))) for k in range(60)]
    rows += [(k, shared[0][: 100 + k] + say(30)) for k in range(100, 180)] + [(200, "x" * 900), (201, "x" * 199), (202, "\0" * 450), (3, rows[3][1]), (3, rows[3][1]), (4, rows[5][1]), (None, rows[6][1]), (None, None), (300, "")]
    got = drop_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), digest=True).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(passages_by_force(rows), key=repr)


def test_secrets(docs, rows, none, spark):
    got = {r.doc_id: r for r in find_secrets(docs).mapInArrow(digested, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string").collect()}
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for i, t, *_ in rows:
        t = t or ""
        found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(t) if len(m[2]) >= 8]
        found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
        base = [x for _, _, x in sorted(found)]
        r = got[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in found) for j in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("grammar")] == base
    assert find_secrets(none).count() == 0
    assert mask("ab secret cd", [{"start": 3, "end": 9}, {"start": 5, "end": 7}], "*") == "ab * cd"


def test_grammar_finds_unlabelled_credentials(spark):
    rng = np.random.default_rng(4)
    key = lambda: "AKIA" + "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), 16))
    rows = [(k, f"some words before {key()} and behind") for k in range(300)]
    rows += [(1000, "look " + key().replace("AKIA", "ASIA") + " here"), (1001, "a page_of_2_words_like_these stays"), (1002, "mail8.example.com-and-more-2")]
    got = {r.doc_id: [s.kind for s in r.spans] for r in find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1000] == [3] and got[1001] == [] and got[1002] == [] and got[5] == [1]


def test_grammar_scores_short_dotted_and_partly_covered_runs(spark):
    rng = np.random.default_rng(5)
    pick = lambda chars, n: "".join(rng.choice(list(chars), n))
    big, letters = "BCDEGHJKLMNPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    keys = [lambda: pick(big, 8) + "." + pick(big, 8), lambda: pick(letters, 10), lambda: pick(letters, 20)]
    rows = [(k, f"some everyday words before password: {keys[k % 3]()} and some more everyday words behind") for k in range(300)]
    odd = [pick(letters, 10), pick(big, 8) + "." + pick(big, 8), pick(letters, 20) + "0123456789abcdef" * 2, "everyday words"]
    rows += [(1000 + k, f"look {x} here") for k, x in enumerate(odd)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1000] == [(3, 5, 15)] and got[1001] == [(3, 5, 22)] and got[1002] == [(3, 5, 25), (2, 25, 57)] and got[1003] == []
    assert all([k for k, *_ in got[i]] == [0] for i in range(300))


def test_background_counts_every_word():
    import pyarrow as arrow

    import tracewright.llm.secrets as S

    texts = ["First words and-then more, é a.b=c1", None, "X password = 'hunter2hunter2' Yz"]
    got = arrow.Table.from_batches(list(S.scanned([arrow.record_batch([arrow.array(texts)], names=["text"])]))).to_pydict()
    want = Counter()
    for t in [texts[0], "X", "Yz"]:
        for w in re.findall(r"[A-Za-z0-9+/_.=-]+", t):
            x = ["", *map(S.symbol, w), ""]
            want.update(zip(x, x[1:]))
    k = len(S.SYMBOLS)
    counts = {(S.SYMBOLS[int(v) // k], S.SYMBOLS[int(v) % k]): n for kind, v, n in zip(*got.values()) if kind < 0}
    assert {x: n for x, n in counts.items() if x != ("", "")} == want
    assert [v for kind, v in zip(got["kind"], got["value"]) if kind >= 0] == ["hunter2hunter2"]


def test_sorted_string_table(tmp_path):
    keys = [int_key(None), *map(int_key, sorted([-5, 0, 1, 2, 2, 2, 900, *range(10_000, 40_000, 3)]))]
    with open(tmp_path / "t", "wb") as f:
        w = Writer(f)
        for k, key in enumerate(keys):
            w.add(key, b"v%d" % k * 5, 1)
        w.close()
    with open(tmp_path / "t", "rb") as f:
        r = Reader(f, (tmp_path / "t").stat().st_size)
        assert [k for k, _ in r] == keys and len(r.index) > 3 and r.entries == r.units == len(keys)
        assert r.get(int_key(2)) == b"v4" * 5 and r.get(int_key(39_997)) == list(r)[-1][1] and r.get(int_key(11)) is None
        assert sum(r.may_hold(int_key(k)) for k in range(10_001, 40_001, 3)) < 500
    with pytest.raises(ValueError):
        w = Writer(open(tmp_path / "u", "wb"))
        w.add(b"b", b"")
        w.add(b"a", b"")


def test_token_files(docs, rows, none, tmp_path, spark):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    manifest = write_tokens(docs, f"file://{tmp_path}/t", path, 2)
    got = {r[0]: tuple(r[1:]) for r in read_tokens(spark, manifest, digest=True).collect()}
    base, want = 0, {}
    for i, t, *_ in rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want[i] = (base, len(ids), zlib.crc32(ids.tobytes()))
        base += len(ids)
    assert got == want
    assert lookup(manifest, 5).tolist() == lib.encode(rows[5][1], add_special_tokens=False).ids + [2] and lookup(manifest, 10**7) is None
    assert read_tokens(spark, write_tokens(none, f"file://{tmp_path}/n", path, 2)).count() == 0


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    lib, at = Tokenizer.from_file(path), defaultdict(list)
    out = pack(docs, path, 2, 256).cache()
    pieces = defaultdict(list)
    for r in out.collect():
        pieces[r.doc_id].append(r)
        at[r.sequence_id].append((r.offset, r.length))
    for i, t, *_ in rows:
        ids, start = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4"), 0
        for k, p in enumerate(sorted(pieces[i], key=lambda p: p.piece)):
            assert (p.piece, p.start) == (k, start) and p.ids_crc32 == zlib.crc32(ids[start : start + p.length].tobytes())
            assert k == 0 or p.length == 256
            start += p.length
        assert start == len(ids)
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    seq = packed_sequences(docs, out, path, 2, 256).collect()
    assert sum(len(r.ids) for r in seq) == sum(r.length for p in pieces.values() for r in p) and len(seq) == len(at)
    assert pack(none, path, 2).count() == 0


def test_local_search_empties_bins():
    rng = np.random.default_rng(1)
    for _ in range(30):
        cap = int(rng.integers(10, 60))
        counts = Counter(rng.integers(1, cap, rng.integers(1, 60)).tolist())
        first = best_fit(counts, cap)
        last = swap_search(first, cap)
        for groups in (first, last):
            assert sum((Counter({k: v * n for k, v in Counter(p).items()}) for p, n in groups), Counter()) == counts
            assert all(0 < sum(p) <= cap for p, _ in groups)
        assert sum(n for _, n in last) <= sum(n for _, n in first)
        table, n = slots(last)
        assert n == sum(k for _, k in last) and len(table["size"])
    assert sum(n for _, n in swap_search([[(6, 2), 1], [(5, 4), 1], [(3,), 1]], 10)) == 2


def test_grammars_on_withheld_credentials():
    """Recall on credentials of the labelled kinds that were not learned from, and false alarms on the words of the smallest table."""
    import duckdb
    import pyarrow as arrow

    import tracewright.llm.secrets as S

    rng = np.random.default_rng(12)
    pick = lambda chars, n: "".join(rng.choice(list(chars), n))
    make = {1: lambda: "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), 2: lambda: pick("0123456789abcdef", 40)}
    known = {k: [f() for _ in range(300)] for k, f in make.items()}
    texts = [r[0] or "" for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    scan = arrow.Table.from_batches(list(S.scanned([arrow.record_batch([arrow.array(texts)], names=["text"])]))).to_pydict()
    counts = {int(v): n for kind, v, n in zip(*scan.values()) if kind < 0}
    grammars = S.Grammars(known, counts)
    for k, f in make.items():
        assert sum(grammars.holds(f()) for _ in range(200)) >= 180, k
    plain = {w for t in texts for w in re.findall(r"[A-Za-z]{8,}", t)}
    assert len(plain) > 1000 and sum(map(grammars.holds, sorted(plain))) <= len(plain) // 100


def test_many_spans_in_one_text_take_linear_time():
    import time

    import tracewright.llm.secrets as S

    text = "token=abcdefgh1234 and-more-words-here " * 30_000
    began = time.perf_counter()
    spans = S.base_spans(text)
    assert len(spans) == 30_000 and len(S.candidates(text, spans)) == 30_000
    assert time.perf_counter() - began < 20
