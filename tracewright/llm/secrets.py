"""Secret scans: fixed patterns, and grammars inferred from the credentials these label."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automata import Automaton, infer, symbol
from .common import Scratch

#: Kinds in the order of their listing; "grammar" are the spans that the automata add.
KINDS = ["assign", "access", "hex", "grammar"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: A candidate: a run of the characters of labelled credentials, of their least length.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
#: Labelled credentials of a kind that an automaton is inferred from: a sample of this bound, in order of their hashes.
SAMPLE = 400
#: Share of the labelled credentials that may score below the limit for a new one of their kind.
LOST = 0.05
#: How much likelier by the grammar than by the background a candidate's mean symbol must be, in nats.
MARGIN = 0.5


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, credential) by start and then kind, in code points."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, spans: list) -> list[tuple[int, int, str]]:
    """(start, end, value) of candidates; of one that spans touch, what they leave of it if that is long enough."""
    out, k, spans = [], 0, sorted((s, e) for s, _, e, _ in spans)
    for m in CANDIDATE.finditer(text):
        at = m.start()
        while k < len(spans) and spans[k][1] <= at:
            k += 1
        j = k  # spans of different kinds may overlap, but those of one kind do not: few of them touch a candidate twice
        while j < len(spans) and spans[j][0] < m.end():
            s, e = spans[j]
            if s - at >= 8:
                out.append((at, s, text[at:s]))
            at, j = max(at, e), j + 1
        if m.end() - at >= 8:
            out.append((at, m.end(), text[at : m.end()]))
    return out


def parts(start: int, value: str) -> list[tuple[int, int, str]]:
    """(start, end, part) of the stretches without a dot of a candidate with one, as these may hold a credential where the whole isn't one."""
    return [(start + m.start(), start + m.end(), m[0]) for m in re.finditer(r"[^.]{8,}", value)] if "." in value else []


#: Symbols of candidates' characters; at 0 whatever bounds a word.
SYMBOLS = ["", "0", "a", "z", "A", "Z", *"+/_.=-"]
CODES = np.zeros(256, np.int64)
for _c in "+/_.=-" + "".join(chr(x) for x in range(128) if chr(x).isalnum()):
    CODES[ord(_c)] = SYMBOLS.index(symbol(_c))
#: What the steps from one symbol of the background are scaled down to, about what a kind's states have.
SCALE = 1000
#: Steps by the symbols' shares that are added to each state of the background.
PRIOR = 10_000


def steps(texts: list[str]) -> np.ndarray:
    """How often each symbol follows each other one in the words of texts."""
    codes = CODES[np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-8", "surrogatepass"), np.uint8)]
    return np.bincount(codes[:-1] * len(SYMBOLS) + codes[1:], minlength=len(SYMBOLS) ** 2)


def scanned(batches):
    """For mapInArrow over (text): (kind, value, n) of a batch: its different labelled credentials, and as kind -1 how often each step of symbols is found outside base spans."""
    for batch in batches:
        labelled, rest = set(), []
        for text in batch.column(0):
            t = text.as_py() or ""
            spans = base_spans(t)
            labelled.update((k, v) for _, k, _, v in spans)
            rest.append(mask(t, [{"start": a, "end": b} for a, _, b, _ in spans], " "))
        n = steps(rest)
        rows = [(k, v, 1) for k, v in sorted(labelled)] + [(-1, str(i), int(n[i])) for i in np.flatnonzero(n)]
        kind, value, count = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(value, pa.string()), pa.array(count, pa.int64())], names=["kind", "value", "n"])


def background(counts: dict[int, int]) -> Automaton:
    """An automaton whose state is the symbol before; PRIOR steps by the symbols' shares are added to each state's, so that a rare state is not shaped by a single credential, and all scaled down so that steps not met weigh about as in a kind's."""
    a, k = Automaton(), len(SYMBOLS)
    ends = [sum(counts.get(j * k + i, 0) for j in range(k) if i or j) for i in range(k)]
    share = [x / max(1, sum(ends)) for x in ends]
    # As in a kind's, a symbol that no word has stays in the state before.
    met = {s: i for i, s in enumerate(SYMBOLS) if i and any(counts.get(i * k + j) for j in range(k))}
    a.next = [met] * k
    a.count, a.total = [{} for _ in range(k)], [0] * k
    for state in range(k):
        row = [(counts.get(state * k + i, 0) + PRIOR * share[i]) if state or i else 0 for i in range(k)]
        by = min(1, SCALE / max(1, sum(row)))
        a.count[state] = {s: n * by for s, n in zip(SYMBOLS, row)}
        a.total[state] = sum(row) * by
    return a


class Grammars:
    """An automaton and a limit for each kind, and one for all words as background."""

    def __init__(self, labelled: dict[int, list[str]], counts: dict[int, int]):
        self.alphabet = 12
        self.counts, self.background = counts, background(counts)
        self.kinds: list[tuple[Automaton, float, int]] = []
        for _, values in sorted(labelled.items()):
            a = infer(values)
            scores = sorted(self.odds(a, v) for v in values)
            self.kinds.append((a, max(MARGIN, scores[int(len(scores) * LOST)]), min(map(len, values))))

    def odds(self, a: Automaton, value: str) -> float:
        s = [symbol(c) for c in value]
        return a.score(s, self.alphabet) - self.background.score(s, self.alphabet)

    def holds(self, value: str) -> bool:
        """Near the limit, the background is taken without the candidate's own steps, as it is without those of labelled credentials."""
        for a, limit, least in self.kinds:
            if len(value) >= least and (odds := self.odds(a, value)) > 0:
                if odds >= limit:
                    return True
                own, symbols = steps([value]), [symbol(c) for c in value]
                rest = background({i: n - int(own[i]) for i, n in self.counts.items()})
                if a.score(symbols, self.alphabet) - rest.score(symbols, self.alphabet) >= limit:
                    return True
        return False


def decided(grammars: Grammars):
    """For mapInArrow over (id, text, ...): (id, spans, ...): base spans and the candidates that a grammar holds."""

    def run(batches):
        memo: dict[str, bool] = {}

        def holds(v: str) -> bool:
            if v not in memo:
                if len(memo) > 100_000:
                    memo.clear()
                memo[v] = grammars.holds(v)
            return memo[v]

        for batch in batches:
            out = []
            for text in batch.column(1):
                t = text.as_py() or ""
                base = base_spans(t)
                spans = [(a, k, b) for a, k, b, _ in base]
                for a, b, v in candidates(t, base):
                    spans += [(a, 3, b)] if holds(v) else [(x, 3, y) for x, y, part in parts(a, v) if holds(part)]
                out.append([dict(zip(("start", "kind", "end"), s)) for s in sorted(spans)])
            kind = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(kind)), *batch.columns[2:]], names=["id", "spans", *batch.schema.names[2:]])

    return run


def train(scan: DataFrame, sample: int = SAMPLE) -> Grammars:
    """Grammars from at most `sample` different labelled credentials of each kind, the first in order of hashes, so that the sample does not depend on partitions, and from the steps of all words, of which there are len(SYMBOLS) ** 2 kinds."""
    values = scan.where("kind >= 0").select("kind", "value").distinct()
    labelled = {}
    for kind in range(3):
        rows = values.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(sample).collect()
        if rows:
            labelled[kind] = [r.value for r in rows]
    counts = scan.where("kind < 0").groupBy("value").agg(F.sum("n").alias("n")).collect()
    return Grammars(labelled, {int(r.value): r.n for r in counts})


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, sample: int = SAMPLE, scratch: Scratch | None = None) -> DataFrame:
    """(id, spans array<struct<start, kind, end>>, carried columns) for each row of docs; see KINDS.

    Base patterns are matched leftmost and without overlap in every whole text (null: empty); matches below their
    kind's length are dropped. Their values label credentials of a kind: an automaton is inferred from each kind's, and
    every other candidate of the corpus (see CANDIDATE; whole and, failing that, its parts between dots; of one that a
    base span touches, each rest of 8 characters or more) is scored by all automata against one of the steps of symbols in all words of all texts. Base spans always
    stay; a candidate is added where a grammar makes it likelier than the background by the limit that 95 % of its
    kind's own credentials pass. Spans count code points, end exclusive, ordered by start and then kind. Without any
    labelled credential nothing is added. Repeated rows come back each; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "secrets")
    carry = carry or []
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carry)])
    types = dict(rows.dtypes)
    more = "".join(f", c{k} {types[f'c{k}']}" for k in range(len(carry)))
    scan = scratch.table(rows.select("text").mapInArrow(scanned, "kind int, value string, n long"), "scan")
    grammars = train(scan, sample)
    out = rows.mapInArrow(decided(grammars), f"id {types['id']}, spans array<struct<start: long, kind: int, end: long>>{more}")
    return out.withColumnsRenamed({"id": id_col} | {f"c{k}": c for k, c in enumerate(carry)})


def digest(spans: list[dict]) -> tuple[int, int, int, str, str]:
    """n_assign, n_access, n_hex, base_sha256, spans as text."""
    said = [(s["kind"], f"{KINDS[s['kind']]}:{s['start']}:{s['end']}") for s in spans]
    base = ",".join(x for k, x in said if k < 3)
    return *(sum(k == i for k, _ in said) for i in range(3)), hashlib.sha256(base.encode()).hexdigest(), ",".join(x for _, x in said)


def digested(batches):
    """For mapInArrow over (id, spans): (id, n_assign, n_access, n_hex, base_sha256, spans)."""
    for batch in batches:
        cols = list(zip(*map(digest, batch.column(1).to_pylist()))) or [()] * 5
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def mask(text: str, spans: list[dict], sign: str) -> str:
    """text with each stretch of overlapping spans replaced by sign."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], sign]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def masked(sign: str):
    """For mapInArrow over (text, spans): (text)."""

    def run(batches):
        for batch in batches:
            got = [mask(t, s, sign) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.string()), *batch.columns[3:]], names=["id", "text", *batch.schema.names[3:]])

    return run
