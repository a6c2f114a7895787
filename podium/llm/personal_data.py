"""Personal data: exact patterns, and a linear-chain conditional random field for what they miss.

The patterns (:func:`base`) take every match or drop it without another try, so
neighbours spoil each other: of ``+1 (269) 555-3296 4111111111111111`` the phone
swallows the card and both are dropped.  The field reads words instead.

- Words that hold a digit or an ``@``, or nothing but ``+().-``, are open; runs of
  open words between which there are only spaces are its sequences.  Every other
  word is outside by rule, so the best labelling of a text is that of its
  sequences, each on its own.
- Features are word shapes: the shape itself (digits one by one, letters in
  runs), with and without the counts of digits, its ends, its digits and dots,
  and the shapes of the words before and after.
- Tags are outside, or begin and inside of each kind; inside follows only its own
  kind.  :func:`train` maximises the penalised likelihood of a small labelled
  table (forward and backward sums in numpy) and is the same on every run.
- :func:`decode` finds the best tags of many sequences at once (Viterbi over numpy
  batches of like length); sequences of the same shapes are decoded once a task.
- A span found is checked exactly (digits, Luhn sum, parts of an address) and is
  added unless it overlaps a pattern's match.

Whole texts are scanned where they are read; there is no shuffle.  The patterns
take time in proportion to the text, whatever it holds.

Defined results: null and empty texts hold nothing; rows are judged one by one,
so rows that repeat, and null ids, are rows like others; an empty table gives an
empty result; extra columns are ignored.  Places are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import mapped, table

KINDS = ("email", "ip", "card", "phone")

#: The labelled table: personal data stands in braces as ``{kind|text}``.
LABELLED = (
    "write to {email|jane.doe@example.com} today",
    "mail {email|first_last@mail.example.org}, or call",
    "{email|x+tag@sub.example.co.uk}",
    "reply to {email|the.34@mail7.example.com} soon",
    "({email|sales@shop.example}) is closed",
    "{email|a1@b2.example.net} {email|info@example.de}",
    "{email|admin@localhost} is local",
    "ask {email|und.78@mail3.example.com} {phone|+1 (974) 555-3436} now",
    "server {ip|10.0.0.1} answered",
    "from {ip|192.168.7.254}, then {ip|8.8.4.4}.",
    "{ip|172.16.254.1} {ip|203.0.113.77}",
    "host {ip|97.51.17.173} port 8080",
    "{ip|161.17.88.162}:",
    "{ip|56.187.231.175} {card|4539578763621486} paid",
    "{ip|21.10.3.9} {phone|+1 (301) 555-0346}",
    "card {card|4111111111111111} is charged",
    "{card|5500000000000004}.",
    "{card|4929348385146306} {card|4417744280351547}",
    "{card|4111 1111 1111 1111} expires 12/27",
    "{card|5105-1051-0510-5100} and 3 more",
    "{card|6011 0009 9013 9424} {phone|+1 (555) 010-2345}",
    "{card|6304000000000000000} has nineteen",
    "{card|4952935900253052} {ip|27.65.93.188}",
    "{card|4524132264652876} {phone|+1 (269) 555-3296}",
    "{card|4736962573099581} {email|de.43@mail4.example.com}",
    "{phone|+1 (269) 555-3296} {card|4524132264652876}",
    "{phone|+1 (578) 555-6437} {card|4918187128635271}",
    "{phone|+1 (208) 555-1177} {card|4284896609045836}.",
    "{phone|+1 (487) 555-7209} {card|4111 1111 1111 1111}",
    "{phone|+1 (243) 555-5526} {phone|+1 (017) 555-7713}",
    "{phone|+1 (132) 555-1352} {ip|123.190.179.76}",
    "{phone|+1 (459) 555-9246} {email|on.23@mail3.example.com}",
    "{phone|+1 (171) 555-2028} 2019 was late",
    "call {phone|+1 (803) 555-5351} at 5",
    "call {phone|+44 20 7946 0958} or write",
    "{phone|+49 30 123456} ext 12",
    "{phone|+33 1 42 68 53 00} {phone|+33 1 42 68 53 01}",
    "{phone|+1-555-010-9999} {ip|10.20.30.40}",
    "{phone|+1.555.010.7788} {card|4417744280351547}",
    "{phone|(212) 555-0143} after 6",
    "{phone|(407) 555-7710} {card|4929348385146306}",
    "tel {phone|+13015550346} {email|st@example.com}",
    "version 3.0 of 2007",
    "release 3.11.2 and 2.7",
    "section 4.2.1. and 4.2.2.",
    "on 2021-03-04 at 12:30",
    "from 1995-2003 to 2010",
    "pages 12 to 15, 120 in all",
    "about 10% or $5.00 each",
    "1,234.56 and 7,000",
    "(2) and (3) follow",
    "(c) 2001 by the authors",
    "ISBN 978-3-16-148410-0 is out",
    "order 20210304123456 shipped",
    "follow @name and @other",
    "C++ + - ( ) ...",
    "rated +5 or -3, at +10%",
    "token = \"9b0b3c6a43eb78aa99cbd7049c572391524f37a8\" here",
    "key 0x1f3a and a1b2c3d4",
    "CC BY-NC 4.0.",
    "License, Version 2.0",
    "call 911 or 112",
    "room 555-12 on 3-4",
    "12 34 56 78 90 12 34",
    "1 2 3 4 5 6 7 8 9",
    "1000000 2000000 3000000",
    "2024 2025 2026 2027",
    "mp3 files, 7z 42x x86-64",
)

_SPACE = r"\x20\x09-\x0D"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# starting at the first of a run of digits, and never giving digits back, finds the same matches in one go
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")
_SOME = re.compile("[0-9@]")
#: open words: from the start of a word on, so that no place is tried twice
_OPEN = re.compile(rf"(?<![^{_SPACE}])(?:[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+|[+().-]++(?![^{_SPACE}]))")


def _digits(s: str) -> list[int]:
    return [int(d) for d in _DIGITS.findall(s)]


def luhn(digits: list[int]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _good_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def _good_card(s: str) -> bool:
    d = _digits(s)
    return 16 <= len(d) <= 19 and luhn(d)


def _good_phone(s: str) -> bool:
    return 8 <= len(_digits(s)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern, from each ``@`` outwards: left over what a local part may hold."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind, then start."""
    if not _SOME.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    for kind, pattern, good in (("ip", _IP, _good_ip), ("card", _CARD, _good_card), ("phone", _PHONE, _good_phone)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if good(m[0])]
    return out


def _core(text: str, start: int, end: int) -> tuple[int, int]:
    """A word's place without the punctuation around it; an opening ``+`` or bracket and a closing bracket stay."""
    while start < end and not (text[start].isalnum() or text[start] in "+("):
        start += 1
    while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
        end -= 1
    return start, end


def sequences(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of open words with only spaces between, as places of their cores (an empty core is the whole word)."""
    now, end = [], -1
    for m in _OPEN.finditer(text):
        if now and text[end : m.start()].strip(" "):
            yield now
            now = []
        a, b = _core(text, *m.span())
        now.append((a, b) if b > a else m.span())
        end = m.end()
    if now:
        yield now


_RUNS = re.compile(r"a+|A+")


def shape(word: str) -> str:
    """Digits as 0, letters as a or A (runs as one), the rest as it is; a very long word has one shape."""
    if len(word) > 64:
        return "long"
    same = "".join("0" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c for c in word)
    return _RUNS.sub(lambda m: m[0][0], same)


def features(s: str) -> list[str]:
    """Features of a shape."""
    digits, dots = s.count("0"), s.count(".")
    return [
        f"shape {s}",
        f"kind {re.sub('0+', '0', s)}",
        f"ends {s[:1]} {s[-1:]}",
        f"digits {min(digits, 20)}",
        f"size {digits.bit_length()}",
        f"dots {min(dots, 4)} {'@' in s}",
    ]


TAGS = ("O", *(f"{place}-{kind}" for kind in KINDS for place in "BI"))


def _allowed() -> np.ndarray:
    """0 where a tag may follow another, else minus infinity; the last row is the start."""
    out = np.zeros((len(TAGS) + 1, len(TAGS)))
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            out[:, j] = -np.inf
            out[[j - 1, j], j] = 0.0
    return out


@dataclass
class Model:
    """Weights: a row of tags for each feature (of the word, the one before, the one after), and of tag after tag."""

    feature: dict[str, int]
    weight: np.ndarray
    follow: np.ndarray

    def scores(self, shapes: list[str], held: dict[str, tuple[np.ndarray, ...]]) -> np.ndarray:
        """Score of every tag for every word; ``held`` remembers the shapes seen."""
        for s in {*shapes, "start", "end"} - held.keys():
            held[s] = tuple(self._sum([f"{side}{f}" for f in features(s)]) for side in ("", "before ", "after "))
        before, after = ["start", *shapes[:-1]], [*shapes[1:], "end"]
        return np.array([held[s][0] + held[p][1] + held[n][2] for s, p, n in zip(shapes, before, after)])

    def _sum(self, names: list[str]) -> np.ndarray:
        return self.weight[[self.feature[f] for f in names if f in self.feature]].sum(axis=0)


def labelled_sequences(lines: Iterable[str]) -> list[tuple[list[str], list[int]]]:
    """Shapes and tags of the sequences of the labelled lines."""
    out = []
    for line in lines:
        text, spans = "", []
        for part in re.split(r"(\{[a-z]+\|[^}]*\})", line):
            m = re.fullmatch(r"\{([a-z]+)\|([^}]*)\}", part)
            if m:
                spans.append((len(text), len(text) + len(m[2]), m[1]))
            text += m[2] if m else part
        for run in sequences(text):
            tags, was = [], None
            for a, b in run:
                span = next((s for s in spans if s[0] < b and a < s[1]), None)
                tags.append(0 if span is None else TAGS.index(f"{'I' if span == was else 'B'}-{span[2]}"))
                was = span
            out.append(([shape(text[a:b]) for a, b in run], tags))
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def train(lines: Iterable[str] = LABELLED, steps: int = 300, penalty: float = 0.02, rate: float = 0.1) -> Model:
    """Weights of the greatest penalised likelihood, by ``steps`` steps of Adam over all sequences at once."""
    rows = labelled_sequences(lines)
    names: dict[str, int] = {}
    placed = []  # sequence, place, feature
    for r, (shapes, _) in enumerate(rows):
        for t, s in enumerate(shapes):
            before, after = shapes[t - 1] if t else "start", shapes[t + 1] if t + 1 < len(shapes) else "end"
            for side, x in (("", s), ("before ", before), ("after ", after)):
                placed += [(r, t, names.setdefault(side + f, len(names))) for f in features(x)]
    at_row, at_place, at_feature = np.array(placed).T
    n, longest, k = len(rows), max(len(s) for s, _ in rows), len(TAGS)
    size = np.array([len(s) for s, _ in rows])
    real = np.arange(longest) < size[:, None]
    gold = np.zeros((n, longest), int)
    for r, (_, tags) in enumerate(rows):
        gold[r, : len(tags)] = tags
    allowed = _allowed()
    before_gold = np.where(np.arange(longest) == 0, k, np.roll(gold, 1, axis=1))
    weights = [np.zeros((len(names), k)), np.zeros((k + 1, k))]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    everyone = np.arange(n)
    for step in range(1, steps + 1):
        weight, follow = weights[0], weights[1] + allowed
        emit = np.zeros((n, longest, k))
        np.add.at(emit, (at_row, at_place), weight[at_feature])
        forward = np.empty((longest, n, k))
        forward[0] = follow[k] + emit[:, 0]
        for t in range(1, longest):
            forward[t] = np.where(real[:, t, None], _logsum(forward[t - 1][:, :, None] + follow[None, :k], 1) + emit[:, t], forward[t - 1])
        total = _logsum(forward[-1], 1)
        backward = np.zeros((longest, n, k))
        for t in range(longest - 2, -1, -1):
            on = _logsum(follow[None, :k] + (emit[:, t + 1] + backward[t + 1])[:, None], 2)
            backward[t] = np.where(real[:, t + 1, None], on, backward[t + 1])
        own = np.exp(np.moveaxis(forward + backward, 0, 1) - total[:, None, None]) * real[:, :, None]
        expected = np.zeros((k + 1, k))
        expected[k] = own[:, 0].sum(axis=0)
        for t in range(1, longest):
            pair = forward[t - 1][:, :, None] + follow[None, :k] + (emit[:, t] + backward[t])[:, None]
            expected[:k] += (np.exp(pair - total[:, None, None]) * real[:, t, None, None]).sum(axis=0)
        seen = np.zeros((k + 1, k))
        np.add.at(seen, (before_gold[real], gold[real]), 1.0)
        residual = -own
        residual[everyone[:, None], np.arange(longest), gold] += real
        slope = np.zeros_like(weight)
        np.add.at(slope, at_feature, residual[at_row, at_place])
        for i, g in enumerate((slope - penalty * weight, seen - expected - penalty * weights[1])):
            m, v = moments[i]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            weights[i] = weights[i] + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(names, weights[0], weights[1] + allowed)


def decode(scores: list[np.ndarray], follow: np.ndarray) -> list[np.ndarray]:
    """The best tags of each sequence (Viterbi), sequences of like length together."""
    out: list[np.ndarray] = [np.empty(0, int)] * len(scores)
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    k = follow.shape[1]
    lo = 0
    while lo < len(order):
        hi = lo + 1
        # a batch is padded to twice the length of its shortest at most
        while hi < len(order) and hi - lo < 4096 and len(scores[order[hi]]) <= 2 * len(scores[order[lo]]):
            hi += 1
        batch = order[lo:hi]
        size = np.array([len(scores[i]) for i in batch])
        longest = int(size.max())
        emit = np.zeros((len(batch), longest, k))
        for r, i in enumerate(batch):
            emit[r, : size[r]] = scores[i]
        best, back = follow[k] + emit[:, 0], np.zeros((longest, len(batch), k), np.int8)
        for t in range(1, longest):
            ways = best[:, :, None] + follow[None, :k]
            going = (t < size)[:, None]
            back[t] = np.where(going, ways.argmax(axis=1), np.arange(k))
            best = np.where(going, ways.max(axis=1) + emit[:, t], best)
        tags = np.empty((len(batch), longest), int)
        tags[:, -1] = best.argmax(axis=1)
        for t in range(longest - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(len(batch)), tags[:, t]]
        for r, i in enumerate(batch):
            out[i] = tags[r, : size[r]]
        lo = hi
    return out


def _checked(text: str, kind: str, a: int, b: int) -> tuple[str, int, int] | None:
    """The span as it may be added: cut to what its kind begins and ends with, if it holds what its kind asks for."""
    inner = "0123456789" if kind != "email" else None
    while a < b and not (text[a] in inner or (kind == "phone" and text[a] in "+(") if inner else text[a].isalnum()):
        a += 1
    while b > a and not (text[b - 1] in inner if inner else text[b - 1].isalnum()):
        b -= 1
    s = text[a:b]
    good = {
        "email": lambda: s.count("@") == 1 and not re.search(rf"[{_SPACE}]", s) and s[0] != "@" and s[-1] != "@",
        "ip": lambda: bool(_IP.fullmatch(s)) and _good_ip(s),
        "card": lambda: bool(_CARD.fullmatch(s)) and _good_card(s),
        "phone": lambda: bool(re.fullmatch(r"[+(]?[0-9][\x20().0-9-]*", s)) and _good_phone(s),
    }
    return (kind, a, b) if s and good[kind]() else None


def _tagged(text: str, run: list[tuple[int, int]], tags: Iterable[int]) -> Iterator[tuple[str, int, int]]:
    """The checked spans of a tagged sequence."""
    open_: list | None = None
    for (a, b), tag in [*zip(run, tags), ((0, 0), 0)]:
        if open_ and TAGS[tag] != f"I-{open_[0]}":
            span = _checked(text, *open_)
            if span:
                yield span
            open_ = None
        if TAGS[tag][0] == "B":
            open_ = [TAGS[tag][2:], a, b]
        elif open_:
            open_[2] = b


#: sequences of shapes whose tags a task remembers, and their words at most
REMEMBERED, SHORT = 1 << 16, 32


class Finder:
    """Finds personal data in texts, remembering what it decoded."""

    def __init__(self, model: Model):
        self.model = model
        self.held: dict[str, tuple[np.ndarray, ...]] = {}
        self.tags: dict[tuple[str, ...], np.ndarray] = {}

    def tag(self, shapes: list[tuple[str, ...]]) -> list[np.ndarray]:
        if len(self.tags) + len(shapes) > REMEMBERED or len(self.held) > REMEMBERED:
            self.tags, self.held = {}, {}
        new = [s for s in dict.fromkeys(shapes) if s not in self.tags]
        now = dict(zip(new, decode([self.model.scores(list(s), self.held) for s in new], self.model.follow)))
        out = [self.tags[s] if s in self.tags else now[s] for s in shapes]
        self.tags |= {s: t for s, t in now.items() if len(s) <= SHORT}
        return out

    def learned(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """The checked spans of the field alone, of each text."""
        found = [(i, run) for i, text in enumerate(texts) if _SOME.search(text) for run in sequences(text)]
        shapes = [tuple(shape(texts[i][a:b]) for a, b in run) for i, run in found]
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        for (i, run), tags in zip(found, self.tag(shapes)):
            out[i] += _tagged(texts[i], run, tags)
        return out

    def find(self, texts: list[str]) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
        """(patterns' matches, added spans) of each text, by kind, then start."""
        out = []
        for text, learned in zip(texts, self.learned(texts)):
            fixed = base(text)
            taken = sorted((a, b) for _, a, b in fixed)
            ends = np.maximum.accumulate(np.array([b for _, b in taken] or [0]))
            starts = np.array([a for a, _ in taken], int)
            # a pattern's match that begins before the span's end must end before its start
            free = lambda a, b: (n := int(np.searchsorted(starts, b))) == 0 or ends[n - 1] <= a
            out.append((fixed, sorted((s for s in learned if free(s[1], s[2])), key=lambda s: (KINDS.index(s[0]), s[1]))))
        return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))


def find(docs: DataFrame, model: Model | None = None, redact: bool = False) -> DataFrame:
    """doc_id and spans (kind, start, end, added by the field; by kind, then start) of every row.

    With ``redact`` also ``redacted``: the text with each span replaced by its kind in brackets
    (of spans that overlap, the one that begins first).
    """
    model = model or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                spans = []
                for fixed, more in finder.find(texts):
                    rows = [(*s, False) for s in fixed] + [(*s, True) for s in more]
                    spans.append([dict(zip(("kind", "start", "end", "added"), s)) for s in sorted(rows, key=lambda s: (KINDS.index(s[0]), s[1]))])
                columns = [part.column(0), pa.array(spans, _SPANS)]
                if redact:
                    columns.append(pa.array([_redacted(t, s) for t, s in zip(texts, spans)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "spans", "redacted"][: len(columns)])

    schema = "doc_id long, spans array<struct<kind: string, start: long, end: long, added: boolean>>"
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema + (", redacted string" if redact else ""))


def _redacted(text: str, spans: list[dict]) -> str:
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    fixed = F.filter("spans", lambda s: ~s["added"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda spans, which: F.size(F.filter(spans, which)).cast("long")
    return found.select(
        "doc_id",
        *[count(fixed, lambda s: s["kind"] == kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(fixed), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count("spans", lambda s: s["added"]).alias("n_added"),
    )
