"""Secret scans: fixed credential patterns, and formats learned from them by grammar inference.

Base patterns find credentials by their form. A bounded sample of what they find
is the labelled set: for each kind a prefix tree of its strings (over classes of
characters) is built and statistically compatible states are merged (ALERGIA,
red-blue order, Hoeffding bounds), which leaves a probabilistic automaton. All
other long tokens of every text are candidates: one is reported, as kind
``format``, where an automaton gives it, length included, a likelihood far above that of an order-3
model of ordinary long tokens. The model is fitted without the tokens that look like
credentials themselves, and the least ratio a symbol comes from labelled strings that
were held back from the automata. A base span is never dropped or changed.

Cases: a null text is empty and has no spans; candidates that overlap a base
span are not reported again; a kind with too few examples has no automaton, and
without any automaton only base spans are reported; rows are judged alone, so
repeated rows repeat and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
KEYS = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "format")

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Base spans in order, and the long tokens of the text.

    Access keys and hex runs lie within long tokens, so those are searched alone;
    assignments are searched where one of their keys occurs.
    """
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    tokens = [m.span() for m in TOKEN.finditer(text)]
    for a, z in tokens:
        if z - a >= 18 and text.find("AKIA", a, z) >= 0:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, a, z)]
        if z - a >= 16:
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, z)]
    found.sort()
    return found, tokens


_CLASS = str.maketrans({**{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "a" for c in "abcdef"}, **{c: "g" for c in "ghijklmnopqrstuvwxyz"}, **{c: "0" for c in "0123456789"}})
SYMBOLS = "Aag0+/_=-."
END = "$"


class Automaton:
    """A deterministic probabilistic automaton: counts of symbols and ends by state."""

    def __init__(self, strings: list[str], alpha: float = 0.01, least: int = 12):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [defaultdict(int)]
        for s in strings:
            q = 0
            for c in s:
                self.count[q][c] += 1
                if c not in self.next[q]:
                    self.next[q][c] = len(self.next)
                    self.next.append({})
                    self.count.append(defaultdict(int))
                q = self.next[q][c]
            self.count[q][END] += 1
        # Length and the classes used, as shares of the strings; "None" is for those not seen.
        self.shares = []
        for seen in (Counter(map(len, strings)), Counter(map(frozenset, strings))):
            whole = len(strings) + 0.5 * (len(seen) + 1)
            self.shares.append({x: math.log((k + 0.5) / whole) for x, k in seen.items()} | {None: math.log(0.5 / whole)})
        self.width, self.least = math.sqrt(0.5 * math.log(2 / alpha)), least
        self._merge_all()
        keep = self._reached()
        name = {q: i for i, q in enumerate(keep)}
        self.next = [{c: name[t] for c, t in self.next[q].items()} for q in keep]
        self.count = [dict(self.count[q]) for q in keep]
        self.logs = []
        for counts in self.count:
            total = sum(counts.values()) + 0.5 * (len(SYMBOLS) + 1)
            self.logs.append({c: math.log((counts.get(c, 0) + 0.5) / total) for c in (*SYMBOLS, END)})
        self.on = [math.log(1 - math.exp(x[END])) for x in self.logs]

    def _reached(self) -> list[int]:
        seen, todo = [0], [0]
        while todo:
            for t in self.next[todo.pop()].values():
                if t not in seen:
                    seen.append(t)
                    todo.append(t)
        return seen

    def _compatible(self, p: int, q: int) -> bool:
        """Whether the two states' symbol frequencies, and their successors', agree within Hoeffding's bound."""
        todo = [(p, q)]
        while todo:
            a, b = todo.pop()
            m, n = sum(self.count[a].values()), sum(self.count[b].values())
            if m < self.least or n < self.least:
                continue
            bound = self.width * (1 / math.sqrt(m) + 1 / math.sqrt(n))
            for c in {*self.count[a], *self.count[b]}:
                if abs(self.count[a].get(c, 0) / m - self.count[b].get(c, 0) / n) > bound:
                    return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a] if c in self.next[b]]
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the subtree at ``tree`` to the automaton at ``into``."""
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            for c, n in self.count[b].items():
                self.count[a][c] += n
            for c, t in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], t))
                else:
                    self.next[a][c] = t

    def _merge_all(self) -> None:
        red = [0]
        while blue := [(q, c, t) for q in red for c, t in self.next[q].items() if t not in red]:
            q, c, t = max(blue, key=lambda x: (sum(self.count[x[2]].values()), -x[2]))
            for r in red:
                if self._compatible(r, t):
                    self.next[q][c] = r
                    self._fold(r, t)
                    break
            else:
                red.append(t)

    def log_likelihood(self, s: str) -> float:
        """Of the symbols, given that the string goes on, of its length and of the classes it uses; far less for a turn that the automaton lacks."""
        q, total = 0, sum(x.get(k, x[None]) for x, k in zip(self.shares, (len(s), frozenset(s)), strict=True))
        for c in s:
            total += self.logs[q].get(c, -12.0) - self.on[q]
            if (t := self.next[q].get(c)) is None:
                return total - 12.0 * (len(s) + 1)
            q = t
        return total


class Ordinary:
    """A model of ordinary long tokens by class of character, of the given order; a context with few examples leans on shorter ones."""

    def __init__(self, strings: list[str], order: int = 3):
        self.order, self.known = order, {}
        self.counts: dict[str, Counter[str]] = defaultdict(Counter)
        for s in strings:
            whole = "^" * order + s + END
            for i in range(order, len(whole)):
                for k in range(order + 1):
                    self.counts[whole[i - k : i]][whole[i]] += 1

    def log(self, context: str, c: str) -> float:
        if (found := self.known.get((context, c))) is None:
            p = 1 / (len(SYMBOLS) + 1)
            for k in range(len(context) + 1):
                counts = self.counts.get(context[len(context) - k :])
                if counts:
                    p = (counts[c] + p) / (counts.total() + 1)
            found = self.known[context, c] = math.log(p)
        return found

    def log_likelihood(self, s: str) -> float:
        whole = "^" * self.order + s + END
        return sum(self.log(whole[i - self.order : i], whole[i]) for i in range(self.order, len(whole)))


class Formats:
    """Automata by kind, the ordinary model, and the least log ratio of a candidate.

    Every fifth labelled string is held back from the automata. The ordinary model is
    fitted ``rounds`` times, each time without the sampled tokens that an automaton
    explains better and whose classes are those of labelled strings (not words in capitals): credentials of unlisted formats in the sample then do not pass for
    ordinary, however many they are. A candidate must be ``odds`` times likelier as
    a credential, and its ratio a symbol at least a third of what all but a
    twentieth of the format's held-back strings reach.
    """

    def __init__(self, labelled: dict[str, list[str]], ordinary: list[str], least: int = 20, odds: float = 1000.0, rounds: int = 4):
        kinds = [[s.translate(_CLASS) for s in v] for _, v in sorted(labelled.items()) if len(v) >= least]
        self.automata = [Automaton([s for i, s in enumerate(v) if i % 5]) for v in kinds]
        plain = [s.translate(_CLASS) for s in ordinary]
        self.known: dict[str, tuple[float, float]] = {}
        self.odds, self.least = math.inf, []
        self.ordinary = Ordinary(plain)
        for _ in range(rounds - 1):
            kept = [s for s in plain if self.ratio(s) <= 0 or not any(frozenset(s) in a.shares[1] for a in self.automata)]
            self.ordinary = Ordinary(kept or plain)
            self.known.clear()
        self.odds = math.log(odds)
        self.least = []  # ratio a symbol, by automaton
        for a, v in zip(self.automata, kinds, strict=True):
            held = sorted((a.log_likelihood(s) - self.ordinary.log_likelihood(s)) / (len(s) + 1) for s in v[::5])
            self.least.append(max(0.0, held[len(held) // 20] / 3))

    def ratios(self, classes: str) -> tuple[float, float]:
        """Log ratio of the best format's likelihood to the ordinary model's, and how far it is above the least."""
        if (r := self.known.get(classes)) is None:
            if len(self.known) > 200_000:
                self.known.clear()
            plain = self.ordinary.log_likelihood(classes)
            found = [a.log_likelihood(classes) - plain for a in self.automata]
            room = [x - max(self.odds, least * (len(classes) + 1)) for x, least in zip(found, self.least, strict=False)]
            r = max(found, default=-math.inf), max(room, default=-math.inf)
            if len(classes) <= 256:  # so that what is remembered is bounded in characters too
                self.known[classes] = r
        return r

    def ratio(self, classes: str) -> float:
        return self.ratios(classes)[0]


def free(found: list[Span], tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The tokens that no span overlaps, in one pass over both; both are in order of start."""
    i = reach = 0
    for a, z in tokens:
        while i < len(found) and found[i][0] < z:
            reach = max(reach, found[i][2])
            i += 1
        if reach <= a:
            yield a, z


def examples(docs: DataFrame, text: str, most: int, ordinary_most: int, longest: int) -> tuple[dict[str, list[str]], list[str]]:
    """A bounded sample of distinct credentials of each base kind and of other long tokens: those of least hash, from all texts.

    Strings are learned whole; those of over ``longest`` characters are not in the sample.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, set[str]] = {k: set() for k in KINDS}
            for t in b.column(0).to_pylist():
                found, tokens = base_spans(t or "")
                for a, k, z in found:
                    m = ASSIGN.match(t, a) if k == 0 else None
                    value = m[2] if m else t[a:z]
                    if len(value) <= longest:
                        out[KINDS[k]].add(value)
                out["format"].update(t[a:z] for a, z in free(found, tokens) if z - a <= longest)
            least = lambda v, n: sorted(v, key=lambda s: hashlib.md5(s.encode()).digest())[:n]
            rows = [(k, s) for k, v in out.items() for s in least(v, most if k != "format" else ordinary_most)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], names=["kind", "value"])

    found = docs.select(F.col(text)).mapInArrow(gather, "kind string, value string").distinct().withColumn("hash", F.md5("value"))
    # The least of each of a kind's 256 parts by hash (eight times their share at most), then of the kind: what all tasks found does not go through one.
    whole = max(most, ordinary_most)
    for by, limit in (([F.col("kind"), F.substring("hash", -2, 2)], max(8, whole // 32)), ([F.col("kind")], whole)):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("hash", "value"))
        found = found.withColumn("n", rank).where(F.col("n") <= limit)
    found = found.where(F.col("n") <= F.when(F.col("kind") == "format", ordinary_most).otherwise(most))
    labelled: dict[str, list[str]] = defaultdict(list)
    for r in found.orderBy("kind", "n").collect():
        labelled[r["kind"]].append(r["value"])
    return labelled, labelled.pop("format", [])


def find_secrets(docs: DataFrame, text: str = "text", most: int = 400, ordinary_most: int = 2000, longest: int = 512) -> DataFrame:
    """Replace ``text`` by its secret spans: kind, start and end (code points) of each, by start.

    Every candidate, a long token that no base span overlaps, is scored whole: the log ratio of its likelihood under the
    best format to that under the ordinary model. A span of kind ``format`` carries its ``score`` (null for base spans);
    n_scored counts a text's candidates and best_score is the highest of their scores, reported or not (null without any).
    ``most`` bounds the labelled credentials of a kind and ``ordinary_most`` the
    ordinary tokens that the automata and their threshold are fitted on, ``longest`` the characters of each of them.
    """
    formats = Formats(*examples(docs, text, most, ordinary_most, longest))

    def scan(texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {"spans": [], "n_scored": [], "best_score": []}
        for t in texts:
            found, tokens = base_spans(t)
            spans: list[tuple[int, int, int, float | None]] = [(*s, None) for s in found]
            n, best = 0, None
            for a, z in free(found, tokens) if formats.automata else ():
                score, room = formats.ratios(t[a:z].translate(_CLASS))
                n, best = n + 1, score if best is None else max(best, score)
                if room >= 0:
                    spans.append((a, 3, z, score))
            spans.sort(key=lambda s: s[:3])
            out["spans"].append([{"kind": KINDS[k], "start": a, "end": z, "score": x} for a, k, z, x in spans])
            out["n_scored"].append(n)
            out["best_score"].append(best)
        return out

    return map_texts(docs, scan, "spans array<struct<kind: string, start: long, end: long, score: double>>, n_scored long, best_score double", text)


def op5_find_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "format")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count("format"), "n_scored", F.round("best_score", 6).alias("best_score"))
