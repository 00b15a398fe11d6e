"""Personal data: patterns, and a skip-chain conditional random field that finds what they miss.

The patterns give the base spans, which always stay. The field runs over the
tokens that hold a digit or an ``@``. Neighbouring tokens form a chain; skip
edges tie every token to the next one in the document with the same content,
and to the nearest ones before and after it that a pattern is certain of,
however far, so that one certain occurrence speaks for the others. A number
that a pattern found over several tokens is one token of the field, and so is
every other run of digits with blanks and signs between that holds the digits
of a number found; what makes them alike are their joined digits. Loopy
belief propagation, run until no message changes, gives each token's label
probabilities.

Factors are fitted piece by piece (each on its own, by smoothed conditional
frequencies, which is the maximum-likelihood fit of indicator features) on a
bounded sample of documents whose tokens the patterns label.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
#: Documents the factors are fitted on, in expectation.
FIT_ROWS = 20_000
#: Messages are passed until none changes by more than this, or for these rounds and FAR more for each token of the longest chain.
SETTLED = 1e-3
ROUNDS = 12
FAR = 4
DAMPING = 0.5
#: Probability from which the field adds a span.
CERTAIN = 0.9
#: Signs of a shape that are kept as they are.
SIGNS = 40

# The four patterns. A match can only start where a run of its first class
# starts, so the look-behinds change nothing but spare repeated scans.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_SOME = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_NOT_DIGIT = re.compile(r"[^0-9]")
_RUN = re.compile(r"[0-9][0-9 ().-]*[0-9]")
#: Kinds whose value is its digits, whatever stands between them.
NUMBERS = frozenset(["card", "phone"])

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def valid(kind: str, found: str) -> bool:
    digits = _NOT_DIGIT.sub("", found)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """Valid matches of the four patterns by start, then kind."""
    if not _SOME.search(text):
        return []
    found = [(a, b, "email") for a, b in emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if valid(kind, m[0])]
    return sorted(found, key=in_order)


def in_order(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def shape(token: str) -> str:
    """Letters, digits and other signs by runs, with the length of digit runs and what the digits would pass.

    Of a long shape the first signs and a digest of the whole stand for it.
    """
    runs = []
    for m in re.finditer(r"([0-9]+)|([^\W\d_]+)|(.)", token):
        runs.append(f"9{len(m[1])}" if m[1] else "a" if m[2] else m[3])
    digits = _NOT_DIGIT.sub("", token)
    marks = [kind for kind in ("card", "phone") if valid(kind, digits)]
    ip = _IP.search(token)
    signs = "".join(runs)
    if len(signs) > SIGNS:
        signs = signs[: SIGNS // 2] + "~" + hashlib.blake2b(signs.encode(), digest_size=8).hexdigest()
    return signs + ":" + ",".join([*marks, *(["ip"] if ip and valid("ip", ip[0]) else [])])


def content(token: str) -> str:
    """What makes two tokens alike: an address with its dots, or letters and digits, if there are enough to mean something."""
    ip = _IP.search(token)
    if ip and valid("ip", ip[0]):
        return ip[0]
    key = "".join(c for c in token if c.isalnum() or c == "@").casefold()
    return key if len(key) >= 6 else ""


@dataclass
class Graph:
    """Tokens of a document, their labels as far as the patterns tell, and the edges between them."""

    spans: list[tuple[int, int]]
    shapes: list[str]
    labels: np.ndarray
    chain: list[int]  # k: tokens k and k + 1 are neighbours in the text
    skips: list[tuple[int, int]]
    alone: np.ndarray  # how many neighbours are plain words
    ties: list[tuple[int, int]]  # from tokens to certain ones alike that are not next to them among those alike
    longest: int  # tokens of the longest chain, of neighbours or of tokens alike
    numbers: list[bool]  # whether a token is a whole number, made of one or more tokens of the text


def whole_numbers(text: str, found: list[tuple[int, int]], base: list[Span]) -> tuple[list[tuple[int, int]], list[set[str]], list[bool]]:
    """Tokens with those of one number made one, the keys that make each alike to others, and which are whole numbers.

    A number is a span of a pattern, or a part of a run of digits that holds the
    same digits as one and overlaps no span. The longest go first, then the leftmost.
    """
    sure = {_NOT_DIGIT.sub("", text[a:b]) for a, b, kind in base if kind in NUMBERS}
    starts, stops = [a for a, _ in found], [b for _, b in found]
    taken: list[tuple[int, int, int, int, str]] = []  # first and last token, start, stop, digits
    free = np.ones(len(found), bool)
    own: dict[int, str] = {}
    for a, b, kind in base:
        first, last = bisect_right(stops, a), bisect_left(starts, b) - 1
        if kind in NUMBERS and free[first : last + 1].all():
            digits = _NOT_DIGIT.sub("", text[a:b])
            if first < last:
                taken.append((first, last, starts[first], stops[last], digits))
            else:
                own[first] = digits
        free[first : last + 1] = False
    if sure:
        most = max(map(len, sure))
        parts = [x for m in _RUN.finditer(text) for x in parts_of_run(text, m.start(), m.end(), starts, stops, most) if x[4] in sure]
        for first, last, a, b, digits in sorted(parts, key=lambda x: (-len(x[4]), x[0])):
            if free[first : last + 1].all():
                free[first : last + 1] = False
                taken.append((first, last, a, b, digits))
    out: list[tuple[int, int]] = []
    keys: list[set[str]] = []
    whole: list[bool] = []
    at = 0
    for first, last, a, b, digits in [*sorted(taken), (len(found), len(found), 0, 0, "")]:
        for n in range(at, first):
            keys.append({content(text[starts[n] : stops[n]]), own.get(n, "")} - {""})
            out.append(found[n])
            whole.append(False)
        if first < len(found):
            keys.append({digits, *(content(text[starts[n] : stops[n]]) for n in range(first, last + 1))} - {""})
            out.append((a, b))
            whole.append(True)
        at = last + 1
    return out, keys, whole


def parts_of_run(text: str, start: int, stop: int, starts: list[int], stops: list[int], most: int) -> Iterator[tuple[int, int, int, int, str]]:
    """Parts of a run from token to token that hold at most so many digits, with no letter or ``@`` on either side."""
    first, last = bisect_right(stops, start), bisect_left(starts, stop) - 1
    pieces = [(max(start, starts[n]), min(stop, stops[n])) for n in range(first, last + 1)]
    joined = [_NOT_DIGIT.sub("", text[a:b]) for a, b in pieces]
    for i, (a, _) in enumerate(pieces):
        if a and (text[a - 1].isalnum() or text[a - 1] in "@_"):
            continue
        digits = ""
        for j in range(i, len(pieces)):
            digits += joined[j]
            if len(digits) > most:
                break
            b = pieces[j][1]
            if not (text[b : b + 1].isalnum() or text[b : b + 1] in ("@", "_")):
                yield first + i, first + j, a, b, digits


def graph(text: str, base: list[Span], whole: bool = True) -> Graph:
    """The field of a text; unless ``whole``, with every token on its own."""
    found = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    if whole:
        found, keys, numbers = whole_numbers(text, found, base)
    else:
        keys, numbers = [{content(text[a:b])} - {""} for a, b in found], [False] * len(found)
    labels = np.zeros(len(found), np.int64)
    k = 0
    for start, stop, kind in sorted(base):
        while k < len(found) and found[k][1] <= start:
            k += 1
        n = k
        while n < len(found) and found[n][0] < stop:
            labels[n] = labels[n] or LABELS.index(kind)
            n += 1
    chain = [n for n in range(len(found) - 1) if text[found[n][1] : found[n + 1][0]].isspace()]
    alike: dict[str, list[int]] = {}
    words = [text[a:b] for a, b in found]
    for n, own in enumerate(keys):
        for key in own:
            alike.setdefault(key, []).append(n)
    # tokens alike by more than one key have one edge all the same
    skips = sorted({pair for own in alike.values() for pair in zip(own, own[1:], strict=False)})
    ties = sorted({pair for own in alike.values() for way in (own, own[::-1]) for pair in certain_ties(way, labels)} - set(skips) - {(b, a) for a, b in skips})
    longest = max([run_length(chain), *map(len, alike.values())])
    alone = np.full(len(found), 2)
    for n in chain:
        alone[n] -= 1
        alone[n + 1] -= 1
    return Graph(found, [shape(w) for w in words], labels, chain, skips, alone, ties, longest, numbers)


def certain_ties(alike: list[int], labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """Each token without a label and the last one with a label before it, if others lie between."""
    certain = None
    for before, n in zip([None, *alike], alike, strict=False):
        if labels[n]:
            certain = n
        elif certain is not None and certain != before:
            yield certain, n


def run_length(chain: list[int]) -> int:
    """Tokens of the longest run of neighbours."""
    best = own = 1
    for k, n in enumerate(chain):
        own = own + 1 if k and chain[k - 1] == n - 1 else 2
        best = max(best, own)
    return best


@dataclass
class Factors:
    """Log factors: by shape, for neighbours (label by label), for tokens alike, for whole numbers by shape ("": any)."""

    node: dict[str, np.ndarray]
    unseen: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    number: dict[str, np.ndarray] = field(default_factory=dict)

    def own(self, shape: str, number: bool) -> np.ndarray:
        if number and shape not in self.node:
            return self.number.get(shape, self.number.get("", self.unseen))
        return self.node.get(shape, self.unseen)


def fit_counts(texts: Iterable[str | None]) -> Counter:
    """How often each shape has each label, and each pair of labels stands on an edge."""
    counts: Counter = Counter()
    for text in texts:
        if not text or not _SOME.search(text):
            continue
        base = base_spans(text)
        g = graph(text, base, whole=False)
        counts.update(("node", s, int(y)) for s, y in zip(g.shapes, g.labels, strict=True))
        # numbers over several tokens count as tokens do, and besides them as the one token they are in the field
        if any(kind in NUMBERS for *_, kind in base):
            parts, w = set(g.spans), graph(text, base)
            for x, s, y, number in zip(w.spans, w.shapes, w.labels, w.numbers, strict=True):
                if number and x not in parts:
                    counts.update([("number", s, int(y)), ("number", "", int(y))])
        counts.update(("chain", str(int(g.labels[n])), int(g.labels[n + 1])) for n in g.chain)
        counts.update(("skip", str(int(g.labels[a])), int(g.labels[b])) for a, b in g.skips)
        for y, n in zip(g.labels, g.alone, strict=True):
            counts["chain", "0", int(y)] += int(n)
    return counts


def factors(rows: Iterable[tuple[str, str, int, int]]) -> Factors:
    n = len(LABELS)
    node: dict[str, np.ndarray] = {}
    number: dict[str, np.ndarray] = {}
    edges = {"chain": np.zeros((n, n)), "skip": np.zeros((n, n))}
    for piece, key, label, count in rows:
        if piece in ("node", "number"):
            (node if piece == "node" else number).setdefault(key, np.zeros(n))[label] += count
        else:
            edges[piece][int(key), label] += count
            edges[piece][label, int(key)] += count
    if "" in number:
        # which kind a whole number of any shape is, is told by those with the same digits
        kinds = [LABELS.index(kind) for kind in sorted(NUMBERS)]
        number[""][kinds] = number[""][kinds].mean()
    total = sum(node.values(), np.zeros(n)) + 1.0
    prior = total / total.sum()

    def log(counts: np.ndarray, weight: np.ndarray | float) -> np.ndarray:
        return np.log((counts + weight * prior) / (counts.sum(axis=-1, keepdims=True) + weight))

    # An edge says how much more often two labels meet than they would by chance. Tokens
    # alike have the same label unless the fit says otherwise, so that side starts ahead.
    # Neighbours of different kinds are rare but possible: a tenth of the weight goes to chance.
    chain = log(edges["chain"], 1.0 + 0.1 * edges["chain"].sum(axis=1, keepdims=True)) - np.log(prior)
    skip = log(edges["skip"] + 5.0 * np.eye(n), 1.0) - np.log(prior)
    return Factors({s: log(c, 1.0) for s, c in node.items()}, np.log(prior), (chain + chain.T) / 2, (skip + skip.T) / 2, {s: log(c, 1.0) for s, c in number.items()})


def posteriors(graphs: list[Graph], f: Factors) -> np.ndarray:
    """Label probabilities of all tokens by loopy belief propagation, all documents at once.

    Tokens inside base spans are held to their label.
    """
    first = np.cumsum([0, *(len(g.spans) for g in graphs)])
    own = np.array([f.own(s, w) for g in graphs for s, w in zip(g.shapes, g.numbers, strict=True)]).reshape(-1, len(LABELS))
    labels, alone = np.concatenate([g.labels for g in graphs]), np.concatenate([g.alone for g in graphs])
    own = own + alone[:, None] * f.chain[0]  # plain words beside a token are surely "other"
    held = labels > 0
    own[held] = -50.0
    own[held, labels[held]] = 0.0
    chain = [(a + n, a + n + 1) for a, g in zip(first, graphs, strict=False) for n in g.chain]
    skips = [(a + n, a + m) for a, g in zip(first, graphs, strict=False) for n, m in [*g.skips, *g.ties]]
    pairs = np.array(chain + skips, np.int64).reshape(-1, 2)
    kind = np.repeat([0, 1], [len(chain), len(skips)])
    document = np.searchsorted(first, pairs[:, 0], "right") - 1
    bound = ROUNDS + FAR * np.array([g.longest for g in graphs])
    weights = np.stack([f.chain, f.skip])
    # Each edge has a message forward (half 0) and one back (half 1). Messages of a document that
    # has settled are added to its tokens for good, and its edges leave the loop.
    messages = np.zeros((2, len(pairs), len(LABELS)))
    rounds = 0
    while len(pairs):
        out = own.copy()
        np.add.at(out, pairs[:, ::-1].T, messages)
        inner = out[pairs.T] - messages[::-1]
        joint = inner[..., None] + np.stack([weights[kind], weights[kind].transpose(0, 2, 1)])
        top = joint.max(axis=2)
        new = top + np.log(np.exp(joint - top[:, :, None, :]).sum(axis=2))
        new -= new.max(axis=2, keepdims=True)
        change = np.abs(new - messages).max(axis=(0, 2))
        messages = DAMPING * messages + (1 - DAMPING) * new
        rounds += 1
        moving = np.zeros(len(graphs), bool)
        moving[document[change > SETTLED]] = True
        done = ~(moving & (rounds < bound))[document]
        if done.any():
            np.add.at(own, pairs[done, ::-1].T, messages[:, done])
            pairs, kind, document, messages = pairs[~done], kind[~done], document[~done], messages[:, ~done]
    out = np.exp(own - own.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def added_spans(text: str, g: Graph, probability: np.ndarray, base: list[Span]) -> list[Span]:
    """Neighbouring tokens with the same certain label, without the signs around them, that no base span touches."""
    label = np.where(probability.max(axis=1) >= CERTAIN, probability.argmax(axis=1), 0)
    label[g.labels > 0] = 0
    chained, out, n = set(g.chain), [], 0
    while n < len(label):
        m = n
        while label[n] and m in chained and label[m + 1] == label[n]:
            m += 1
        if label[n]:
            start, stop = g.spans[n][0], g.spans[m][1]
            while start < stop and not (text[start].isalnum() or text[start] == "+"):
                start += 1
            while stop > start and not text[stop - 1].isalnum():
                stop -= 1
            if start < stop and not any(a < stop and start < b for a, b, _ in base):
                out.append((start, stop, LABELS[label[n]]))
        n = m + 1
    return out


def find_spans(texts: list[str | None], f: Factors) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t or "") for t in texts]
    out = [(b, b) for b in base]
    live = [k for k, t in enumerate(texts) if t and _SOME.search(t)]
    graphs = [graph(texts[k], base[k]) for k in live]
    if any(len(g.spans) for g in graphs):
        marginals, at = posteriors(graphs, f), 0
        for k, g in zip(live, graphs, strict=True):
            more = added_spans(texts[k], g, marginals[at : at + len(g.spans)], base[k])
            at += len(g.spans)
            out[k] = (base[k], sorted([*base[k], *more], key=in_order))
    return out


def fitted_factors(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Factors:
    """Factors from about ``fit_rows`` documents, drawn by a hash of id and text."""
    total = docs.count()
    sample = docs.select(F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("h"))
    if total > fit_rows:
        sample = sample.filter(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * fit_rows / total))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts += fit_counts(batch.column("text").to_pylist())
        if counts:
            pieces, keys, labels = zip(*counts, strict=True)
            yield pa.RecordBatch.from_pydict({"piece": pieces, "key": keys, "label": pa.array(labels, pa.int32()), "n": pa.array(counts.values(), pa.int64())})

    counted = sample.select("text").mapInArrow(count, "piece string, key string, label int, n long")
    # shapes that were seen once say nothing that the prior does not
    rows = counted.groupBy("piece", "key", "label").agg(F.sum("n").alias("n")).filter("n > 1 or piece NOT IN ('node', 'number')").collect()
    return factors((r["piece"], r["key"], r["label"], r["n"]) for r in rows)


SPANS = "array<struct<kind:string,start:int,stop:int>>"
FOUND = f"doc_id long, text string, base {SPANS}, spans {SPANS}"


def personal_data(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Base spans and all spans of every text.

    docs: doc_id, text; other columns are ignored. Returns doc_id, text, base
    and spans (kind, start, stop: code points, stop exclusive), one row per row
    of ``docs``, without a shuffle. Null and empty texts have no spans, rows
    alike in all columns have the same, no rows give none. Texts of any length
    are one field each. Its messages are passed until none changes by more than
    ``SETTLED``, at most ``ROUNDS`` rounds and ``FAR`` more for every token of the
    longest chain; a field that still swings then is read as it stands. The
    field never removes or changes a base span, and adds none that overlaps one.
    Its factors come from about ``fit_rows`` documents; of their shapes, one
    seen once is left to the prior.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(fitted_factors(docs, fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = find_spans(batch.column("text").to_pylist(), shared.value)
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
                lists = [pa.array([[{"kind": k, "start": a, "stop": b} for a, b, k in x[n]] for x in found], kind) for n in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), *lists], names=["doc_id", "text", "base", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, FOUND)


def pii_digest(docs: DataFrame) -> DataFrame:
    found = personal_data(docs)
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    numbers = [F.expr(f"CAST(size(filter(base, x -> x.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *numbers, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redacted(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """All rows and columns of ``docs``, with every span replaced by its kind in brackets.

    n_chars, if there is such a column, follows the text. Null texts stay null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fitted_factors(docs, fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column("text").to_pylist()
                found = find_spans(texts, shared.value)
                new = [t if t is None else replaced(t, spans) for t, (_, spans) in zip(texts, found, strict=True)]
                yield batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"), pa.array(new, batch.schema.field("text").type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def replaced(text: str, spans: list[Span]) -> str:
    """Overlapping spans are hidden together, under the kind of the first."""
    out, at = [], 0
    for start, stop, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])

