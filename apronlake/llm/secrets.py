"""Secret scans: base patterns, and formats learned by grammar inference.

Base spans follow three patterns (an assignment to a credential's name, an access key,
a long hexadecimal run). The values of base matches are labelled credentials. A bounded
sample of them (``max_labelled`` of up to ``max_length`` characters, those of lowest hash)
makes a prefix tree, letters in one case: at a node a character that a fifth of its strings
go on with is a branch of its own, all other letters and digits are one branch, other
symbols one each. States of the tree are merged as in ALERGIA: in breadth-first order a
state joins an earlier one if the frequencies of ending and of each branch agree within
Hoeffding bounds, and those of their successors do too. The result is a probabilistic
automaton; each state has its own distribution of characters within a branch.

Every token of ``least`` or more characters is then scored: mean log likelihood a character
under the automaton, less that under a bigram model of ordinary tokens (a bounded sample as
well, mixed with a fifth of equal chances). Tokens above the threshold and off all base spans are
added as kind ``format``. The threshold is the second percentile of held-out credentials,
but at least their median less four times their quartiles' distance, and at least the
median of held-out ordinary tokens plus six times their quartiles' distance, which a few
unlabelled credentials among them do not move.

``least`` is 8, as in the base patterns; that and the two sample sizes are the only bounds.
Tokens are scored whole, however long.

Cases. Null and empty texts: no spans. Very long texts are read whole. With fewer than
four labelled credentials nothing is added; with fewer than 50 ordinary tokens the
background is equal chances. Repeated rows: each by itself. Null doc_id: a row like any
other. Equal starts: base kinds as listed, then ``format``. Empty table: no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import settle, table
from .wordhash import find_words, slices

#: Fixed patterns of the base kinds, in the order of listing; letters of the name in either case.
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "format")


def _class(chars: str) -> np.ndarray:
    x = np.zeros(256, dtype=bool)
    x[[ord(c) for c in chars]] = True
    return x


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = _class(_DIGITS + "abcdef")
TOKEN = _class(_DIGITS + _LOWER + _UPPER + "+/_.=-")

END = "$"
#: Branch of the letters and digits without one of their own.
OTHER = "x"
#: Strings of this share of a node go on with a character: it gets a branch.
BRANCH = 0.2
#: Weight of an end or a branch that a state has never seen: formats are strict.
UNSEEN = 1e-12
#: Share of equal chances in the background.
EQUAL = 0.2
#: Letters and digits in one case.
_N = 36
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


class Automaton:
    """A probabilistic automaton: counts of ends, branches and characters, and where branches lead."""

    def __init__(self, strings: list[str], alpha: float = 0.01):
        self.counts: list[Counter] = []
        self.chars: list[Counter] = []
        self.to: list[dict[str, int]] = []
        self._grow([s.lower() for s in strings])
        self._merge_compatible(alpha)
        self.total = [sum(c.values()) for c in self.counts]

    def _node(self) -> int:
        self.counts.append(Counter())
        self.chars.append(Counter())
        self.to.append({})
        return len(self.to) - 1

    def _grow(self, strings: list[str]) -> None:
        todo = [(self._node(), 0, strings)]
        while todo:
            at, depth, own = todo.pop()
            seen = Counter(s[depth] for s in own if len(s) > depth)
            self.chars[at] = seen
            # A fifth of the strings, and more than chance makes of ten equal characters.
            many = max(BRANCH * len(own), 0.1 * len(own) + 4 * math.sqrt(0.1 * len(own)))
            parts: dict[str, list[str]] = defaultdict(list)
            for s in own:
                c = s[depth] if len(s) > depth else END
                parts["=" + c if c != END and (seen[c] >= many or not c.isalnum()) else OTHER if c != END else END].append(s)
            for symbol in sorted(parts):
                self.counts[at][symbol] = len(parts[symbol])
                if symbol != END:
                    self.to[at][symbol] = self._node()
                    todo.append((self.to[at][symbol], depth + 1, parts[symbol]))

    def _differ(self, a: int, b: int, bound: float) -> bool:
        m, n = self.counts[a].total(), self.counts[b].total()
        if not m or not n:
            return False
        limit = bound * (1 / math.sqrt(m) + 1 / math.sqrt(n))
        return any(abs(self.counts[a][c] / m - self.counts[b][c] / n) > limit for c in self.counts[a].keys() | self.counts[b].keys())

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self.counts[b].total() <= bound * bound:
                continue  # too few strings for any difference to count, here and below
            if self._differ(a, b, bound):
                return False
            todo += [(self.to[a][c], self.to[b][c]) for c in self.to[a].keys() & self.to[b].keys() if self.to[a][c] != self.to[b][c]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.counts[a].update(self.counts[b])
            self.chars[a].update(self.chars[b])
            for c, t in self.to[b].items():
                if c in self.to[a]:
                    todo.append((self.to[a][c], t))
                else:
                    self.to[a][c] = t

    def _merge_compatible(self, alpha: float) -> None:
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        kept, place = [0], {0: 0}
        at = 0
        while at < len(kept):
            # Folding may add branches to states before this one: they are looked at again.
            again = [(s, c) for s in kept[: at + 1] for c in sorted(self.to[s]) if self.to[s][c] not in place]
            if not again:
                at += 1
                continue
            parent, c = again[0]
            state = self.to[parent][c]
            for other in kept:
                if self._compatible(other, state, bound):
                    self.to[parent][c] = other
                    self._fold(other, state)
                    break
            else:
                place[state] = len(kept)
                kept.append(state)
        self.counts, self.chars = [self.counts[s] for s in kept], [self.chars[s] for s in kept]
        self.to = [{c: place[t] for c, t in self.to[s].items()} for s in kept]

    def step(self, at: int, c: str) -> tuple[float, int]:
        """(log likelihood, next state) of a character; an unknown move starts again at the root."""
        own = "=" + c
        if own in self.to[at] or not c.isalnum():
            n, share, to = self.counts[at][own], 1.0, self.to[at].get(own, 0)
        else:
            n, to = self.counts[at][OTHER], self.to[at].get(OTHER, 0)
            inside = sum(k for x, k in self.chars[at].items() if x.isalnum() and "=" + x not in self.to[at])
            share = (self.chars[at][c] + 0.5) / (inside + 0.5 * _N)
        return math.log((n + UNSEEN) / (self.total[at] + UNSEEN)) + math.log(share), to

    def end(self, at: int) -> float:
        return math.log((self.counts[at][END] + UNSEEN) / (self.total[at] + UNSEEN))

    def likelihood(self, s: str) -> float:
        """Mean log likelihood a symbol, the end included."""
        at, total = 0, 0.0
        for c in s.lower():
            p, at = self.step(at, c)
            total += p
        return (total + self.end(at)) / (len(s) + 1)


class Format:
    """Credentials' automaton, ordinary tokens' bigrams, and the threshold between them, as tables over bytes."""

    def __init__(self, credentials: list[str], ordinary: list[str]):
        self.automaton = Automaton(credentials[::2] if len(credentials) >= 8 else credentials)
        plain = ordinary[::2] if len(ordinary) >= 50 else []
        known = "".join(chr(b) for b in np.flatnonzero(TOKEN) if not 65 <= b <= 90)
        n = len(self.automaton.to)
        self.move, self.log = np.zeros((n, 256), dtype=np.int64), np.zeros((n, 256))
        for s in range(n):
            for c in known:
                self.log[s, ord(c)], self.move[s, ord(c)] = self.automaton.step(s, c)
        self.log_end = np.array([self.automaton.end(s) for s in range(n)])
        # Row 0 of the bigrams: first characters; column 0: the end. The rest are equal chances.
        pairs = np.zeros((256, 256))
        for t in plain:
            b = _FOLD[np.frombuffer(t.encode(), dtype=np.uint8)]
            np.add.at(pairs, (np.append(0, b), np.append(b, 0)), 1)
        seen = pairs.sum(axis=1, keepdims=True)
        self.plain = np.log(np.where(seen > 0, (1 - EQUAL) * pairs / np.maximum(seen, 1) + EQUAL / len(known), 1 / len(known)))
        good = self.scores(credentials[1::2] if len(credentials) >= 8 else credentials)
        lowest, low, middle, high = np.quantile(good, [0.02, 0.25, 0.5, 0.75])
        self.threshold = float(max(lowest, middle - 4 * (high - low)))
        if plain:
            low, middle, high = np.quantile(self.scores(ordinary[1::2]), [0.25, 0.5, 0.75])
            self.threshold = max(self.threshold, float(middle + 6 * (high - low)))

    def scores(self, tokens: list[str]) -> np.ndarray:
        data = np.frombuffer("".join(tokens).encode(), dtype=np.uint8)
        end = np.cumsum([len(t) for t in tokens])
        return self.score(data, end - [len(t) for t in tokens], end)

    def score(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Scores of the tokens data[start:end], all of them a character further at a time."""
        data = _FOLD[data]
        size = end - start
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        state, last, total = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64), np.zeros(len(size))
        for i in range(int(size.max(initial=0))):
            n = int(np.searchsorted(-size, -i, side="left"))  # tokens of more than i characters come first
            c = data[start[:n] + i]
            total[:n] += self.log[state[:n], c] - self.plain[last[:n], c]
            state[:n], last[:n] = self.move[state[:n], c], c
        out = np.empty(len(size))
        out[order] = (total + self.log_end[state] - self.plain[last, 0]) / (size + 1)
        return out


def _found(data: np.ndarray, offsets: np.ndarray, least: int):
    """For each document: code-point base spans (start, kind, end, value); and candidate tokens off them.

    Tokens are (document, code-point start and end, first byte, end byte), an array each.
    """
    n = len(offsets) - 1
    raw = data.tobytes()
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    spans: list[list] = [[] for _ in range(n)]
    w = find_words(data, offsets, HEX)
    for i in np.flatnonzero(w.end - w.start >= 32):
        d = int(w.doc[i])
        zero = point[offsets[d]]
        spans[d].append((int(point[w.start[i]] - zero), 2, int(point[w.end[i]] - zero), raw[w.start[i] : w.end[i]].decode()))
    signs = np.concatenate([[0], np.cumsum((data == 0x3D) | (data == 0x3A))])
    maybe = signs[offsets[1:]] > signs[offsets[:-1]]
    for d in range(n):
        part = raw[offsets[d] : offsets[d + 1]]
        if maybe[d]:
            text = part.decode()
            spans[d] += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        if b"AKIA" in part:
            spans[d] += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(part.decode()) if len(m[0]) >= 16]
        spans[d].sort()
    w = find_words(data, offsets, TOKEN)
    long_ = np.flatnonzero(w.end - w.start >= least)
    doc, first, last = w.doc[long_], w.start[long_], w.end[long_]
    # Code points covered by base spans, counted over the whole slice.
    edge = np.zeros(int(point[-1]) + 1, dtype=np.int64)
    for d in range(n):
        for a, _, b, _ in spans[d]:
            edge[point[offsets[d]] + a] += 1
            edge[point[offsets[d]] + b] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge) > 0)])
    free = covered[point[last]] == covered[point[first]]
    doc, first, last = doc[free], first[free], last[free]
    zero = point[offsets[doc]]
    return spans, (doc, point[first] - zero, point[last] - zero, first, last)


def _order(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "big", signed=True)


def _sampler(least: int, most: int, max_length: int):
    """The ``most`` labelled and ordinary tokens of lowest hash of each slice."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                spans, (_, _, _, first, last) = _found(data, offsets, least)
                raw = data.tobytes()
                sets = ({s[3] for of in spans for s in of}, {raw[x:y].decode() for x, y in zip(first, last) if y - x <= max_length})
                rows = [(label, h, v) for label, values in zip((1, 0), sets) for h, v in sorted((_order(v), v) for v in values if len(v) <= max_length)[:most]]
                columns = list(zip(*rows)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["label", "h", "value"])

    return sample


def learn_format(docs: DataFrame, least: int = 8, max_labelled: int = 1000, max_length: int = 512) -> Format | None:
    """Fit on at most ``max_labelled`` distinct credentials and as many ordinary tokens."""
    seen = settle(docs.select("text").mapInArrow(_sampler(least, max_labelled, max_length), "label long, h long, value string"), "token-sample")
    sets = []
    for label in (1, 0):
        rows = seen.where(F.col("label") == label).select("h", "value").distinct().orderBy("h", "value").limit(max_labelled).collect()
        sets.append([r.value for r in rows])
    return Format(*sets) if len(sets[0]) >= 4 else None


def _scanner(known: Format | None, least: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offsets in slices(batch.column(1)):
                spans, (doc, x, y, first, last) = _found(data, offsets, least)
                every = [list(of) for of in spans]
                if known and len(doc):
                    for i in np.flatnonzero(known.score(data, first, last) > known.threshold):
                        every[doc[i]].append((int(x[i]), 3, int(y[i]), ""))
                rows = []
                for of, all_ in zip(spans, every):
                    n = Counter(s[1] for s in of)
                    base = ",".join(f"{KINDS[k]}:{p}:{q}" for p, k, q, _ in of)
                    rows.append((n[0], n[1], n[2], hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{KINDS[k]}:{p}:{q}" for p, k, q, _ in sorted(all_))))
                columns = list(zip(*rows))
                types = [pa.int64()] * 3 + [pa.string()] * 2
                arrays = [ids.slice(a, b - a), *(pa.array(c, t) for c, t in zip(columns, types))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scan


def find_secrets(docs: DataFrame, known: Format | None, least: int = 8) -> DataFrame:
    """One row per document: counts and digest of base spans, and all spans."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scanner(known, least), schema)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return find_secrets(docs, learn_format(docs))
