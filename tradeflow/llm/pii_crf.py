"""Personal data in text: four base patterns, and a linear-chain conditional random field over word shapes.

The field is trained from a small labelled table (``labelled_table``: sentences whose tokens carry a kind or
none, made from a few sentence frames and number formats) by full-batch gradient ascent on the exact conditional
likelihood, and decoded by Viterbi in numpy batches. It adds what the patterns' fixed forms miss (numbers without
a plus sign, spelt-out addresses, card numbers with other separators). Part of the model is the rule that a label
other than ``O`` stands at most ``REACH`` words from a trigger (a digit, an at sign, a bracketed "at" or "dot"); a
text therefore falls apart into windows that are decoded exactly, and words outside them are ``O``.

Defined cases: a null text is empty and has no spans; spans of the field that overlap a base span are left out;
equal starts are ordered by kind; repeated rows repeat; an empty table gives an empty table; columns beyond id and
text are left out by ``find`` and kept as they are by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.text import map_texts, slices

#: In the order in which equal starts are listed.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
REACH = 4

# The base patterns. The local part of an email is looked for to the left of its at sign; the
# look-behind and the possessive repeats keep the others linear and match the same spans.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        n = int(ch)
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_SET:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, place of the kind, end)`` of the base patterns' matches, in order."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---------------------------------------------------------------- word shapes

_RUNS = re.compile(r"([A-Z]+)|([a-z]+)|([0-9]+)|([^\x00-\x7f]+)|(.)", re.S)
_CUES = frozenset(
    "call phone tel telephone mobile fax ring number email mail e-mail write address card visa pay account ip host server ping at dot from "
    "order invoice version page year price room total date".split()
)


@lru_cache(maxsize=200_000)
def word_features(word: str) -> tuple[str, ...]:
    """Features of one word: shape with run lengths, shape without, digit counts, cue words and check sums."""
    fine, coarse = [], []
    for m in _RUNS.finditer(word):
        kind = "XxdU"[m.lastindex - 1] if m.lastindex < 5 else m[0]
        fine.append(f"{kind}{min(len(m[0]), 20)}" if m.lastindex == 3 else kind)
        if not coarse or coarse[-1] != kind:
            coarse.append(kind)
    digits = _digits(word)
    core = word.lower().strip(".,;:!?()[]{}\"'<>")
    out = [f"f={''.join(fine)[:24]}", f"c={''.join(coarse)[:12]}", f"n={min(len(digits), 20)}"]
    if core in _CUES:
        out.append(f"w={core}")
    if "@" in word:
        out.append("at")
    if len(digits) >= 14:
        out.append(f"luhn={luhn(digits)}")
    if word.count(".") == 3 and len(digits) >= 4 and not re.search("[A-Za-z]", word):
        parts = word.strip(".,;:!?()").split(".")
        out.append(f"octets={all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}")
    if word[:1] in "+(":
        out.append("open")
    return tuple(out)


def sequence_features(words: list[str]) -> list[list[str]]:
    """Own features of every word, those of both neighbours, digits of the whole run of number-like words, cues before."""
    own = [word_features(w) for w in words]
    numeric = [bool(_DIGIT.search(w)) and not re.search("[A-Za-z]{2}", w) for w in words]
    run_digits, run_luhn = [0] * len(words), [""] * len(words)
    k = 0
    while k < len(words):
        if numeric[k]:
            stop = k
            while stop < len(words) and numeric[stop] and stop - k < 12:
                stop += 1
            digits = "".join(_digits(w) for w in words[k:stop])
            for j in range(k, stop):
                run_digits[j], run_luhn[j] = min(len(digits), 24), f"{14 <= len(digits) <= 19 and luhn(digits)}"
            k = stop
        else:
            k += 1
    out = []
    for k, feats in enumerate(own):
        row = ["bias", *feats]
        row += [f"-1{x}" for x in own[k - 1]] if k else ["-1^"]
        row += [f"+1{x}" for x in own[k + 1]] if k + 1 < len(words) else ["+1$"]
        if numeric[k]:
            row += [f"run={run_digits[k]}", f"runluhn={run_luhn[k]}", f"first={k == 0 or not numeric[k - 1]}"]
        for back in (2, 3):
            if k >= back:
                row += [f"near{x}" for x in own[k - back] if x.startswith("w=")]
        out.append(row)
    return out


# ---------------------------------------------------------------- the labelled table

# Sentence frames; "{}" is the place of the labelled words.
_FRAMES = {
    "email": ("write to {} today", "my email is {} thanks", "{} is the address", "mail {} or wait", "a la dirección {} por favor", "schreib an {} bitte", "écrivez à {} vite", "the and of {} with in"),
    "ip": ("host {} is down", "ping {} now", "the server at {} answered", "from ip {} at night", "serveur {} hors ligne", "the and of {} with in"),
    "card": ("card {} expires soon", "pay with visa {} please", "account {} was used", "la tarjeta {} caducó", "Karte {} gesperrt", "the and of {} with in"),
    "phone": ("call {} today", "my phone is {} thanks", "tel {} or fax", "ring {} at noon", "llame al {} mañana", "Telefon {} abends", "appelez le {} demain", "the and of {} with in"),
    "": ("order {} is late", "in the year {} it rained", "version {} is out", "a price of {} was paid", "page {} of the book", "total {} items", "el año {} fue", "im Jahr {} war", "the and of {} with in", "meet at {} in room"),
}
# Formats; "#" is a digit, "~" one of 1 to 9. Card formats are completed to pass the check sum.
_FORMATS = {
    "email": ("ann.lee@mail#.example.com", "bob_##@test.org", "kim [at] example [dot] com", "lea (at) mail (dot) net", "max.#@site.example.co.uk", "zoe at mail# [dot] org"),
    "ip": ("~#.~#.~.~#", "1##.~#.~.1##", "10.~.~#.~", "~.~#.1##.~#"),
    "card": ("~###############", "~### #### #### ####", "~###-####-####-####", "~###.####.####.####", "~###/####/####/####", "~### ###### #####"),
    "phone": ("+1 (~##) 555-####", "(~##) ###-####", "~##-###-####", "~##.###.####", "+~# ~## ### ####", "00~# ~## ######", "0~## ### ## ##"),
    "": ("19##", "20##", "~#.##", "#.#.#", "~##", "#", "~###-0~-1#", "1#:##", "~,###,###", "#.#.#.#.#", "~#%", "No. ~###", "~########", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "~##.###.4##.9##", "~##############7x", "#/#", "x#", "($##)", "=", "@home", "a@b", "bad ~###############"),
}


def labelled_table(repeats: int = 6, seed: int = 11) -> list[tuple[list[str], list[int]]]:
    """Sentences as ``(words, label numbers)``: every format in ``repeats`` frames, with digits drawn from a seeded generator."""
    rng = np.random.default_rng(seed)
    out = []
    for kind, formats in _FORMATS.items():
        for form in formats:
            for _ in range(repeats if kind else 3 * repeats):
                text = re.sub("[#~]", lambda m: str(rng.integers(m[0] == "~", 10)), form)
                wrong = text.startswith("bad ")
                text = text.removeprefix("bad ")
                if kind == "card" or wrong:
                    digits = _digits(text)
                    last = next(n for n in range(10) if luhn(digits[:-1] + str(n)))
                    text = text[:-1] + str((last + wrong * int(rng.integers(1, 10))) % 10)
                before, after = str(rng.choice(_FRAMES[kind])).split("{}")
                tail = str(rng.choice(["", "", ".", ",", "###", "!"])) if kind else ""
                filler = [str(x) for x in rng.choice(["thing", "Rest", "ending", "was", "und", "la", "éau"], int(rng.integers(0, 3)))]
                middle = (text + tail).split()
                words = [*filler, *before.split(), *middle, *after.split()]
                labels = [0] * len(words)
                at = len(filler) + len(before.split())
                for k in range(len(middle) if kind else 0):
                    labels[at + k] = LABELS.index(f"{'I' if k else 'B'}-{kind}")
                out.append((words, labels))
    return out


# ---------------------------------------------------------------- the field


@dataclass
class Field:
    features: dict[str, int]
    emit: np.ndarray  # features by labels
    move: np.ndarray  # label to label; row len(LABELS) starts a window

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(LABELS)))
        for k, row in enumerate(sequence_features(words)):
            known = [self.features[x] for x in row if x in self.features]
            out[k] = self.emit[known].sum(0)
        return out

    def decode(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """Best labels of every sequence; Viterbi over batches of sequences of similar length."""
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and stop - at < 512 and len(sequences[order[stop]]) * (stop + 1 - at) <= 200_000:
                stop += 1
            chosen = order[at:stop]
            at = stop
            sizes = np.array([len(sequences[k]) for k in chosen])
            steps = int(sizes.max()) if len(sizes) else 0
            if not steps:
                continue
            scores = np.zeros((len(chosen), steps, len(LABELS)))
            for row, k in enumerate(chosen):
                scores[row, : sizes[row]] = self.emissions(sequences[k])
            best = self.move[-1] + scores[:, 0]
            back = np.zeros((len(chosen), steps, len(LABELS)), np.int8)
            for t in range(1, steps):
                through = best[:, :, None] + self.move[None, :-1]
                back[:, t] = through.argmax(1)
                moved = through.max(1) + scores[:, t]
                best = np.where((t < sizes)[:, None], moved, best)
            labels = np.zeros((len(chosen), steps), np.int64)
            now = best.argmax(1)
            rows = np.arange(len(chosen))
            for t in range(steps - 1, -1, -1):
                inside = t < sizes
                labels[inside, t] = now[inside]
                if t:
                    now = np.where(inside, back[rows, t, now], now)
            for row, k in enumerate(chosen):
                found[k] = labels[row, : sizes[row]]
        return found


def _forbidden() -> np.ndarray:
    """True where a label cannot follow: an inner label needs its own kind before it."""
    n = len(LABELS)
    bad = np.zeros((n + 1, n), bool)
    for b, label in enumerate(LABELS):
        if label[0] == "I":
            bad[:, b] = True
            for a, before in enumerate(LABELS):
                if before[1:] == label[1:]:
                    bad[a, b] = False
    return bad


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(table: list[tuple[list[str], list[int]]] | None = None, steps: int = 120, rate: float = 0.3, decay: float = 1e-3) -> Field:
    """Field fitted to the labelled table by AdaGrad on the exact log likelihood (forward-backward over all sentences at once)."""
    table = labelled_table() if table is None else table
    features: dict[str, int] = {}
    rows = [[[features.setdefault(x, len(features)) for x in word] for word in sequence_features(words)] for words, _ in table]
    n, steps_max, k = len(table), max(len(r) for r in rows), len(LABELS)
    size = np.array([len(r) for r in rows])
    spot = np.array([(a * steps_max + t, f) for a, r in enumerate(rows) for t, word in enumerate(r) for f in word])
    gold = np.full((n, steps_max), -1)
    for a, (_, labels) in enumerate(table):
        gold[a, : len(labels)] = labels
    inside = gold >= 0
    one_hot = np.zeros((n, steps_max, k))
    one_hot[inside, gold[inside]] = 1
    bad = _forbidden()
    emit, move = np.zeros((len(features), k)), np.where(bad, -1e4, 0.0)
    true_move = np.zeros((k + 1, k))
    np.add.at(true_move, (k, gold[:, 0]), 1)
    for t in range(1, steps_max):
        both = inside[:, t]
        np.add.at(true_move, (gold[both, t - 1], gold[both, t]), 1)
    ge, gm = np.full_like(emit, 1e-6), np.full_like(move, 1e-6)
    for _ in range(steps):
        scores = np.zeros((n * steps_max, k))
        for b in range(k):
            scores[:, b] = np.bincount(spot[:, 0], weights=emit[spot[:, 1], b], minlength=n * steps_max)
        scores = scores.reshape(n, steps_max, k)
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[:, 0] = move[-1] + scores[:, 0]
        for t in range(1, steps_max):
            new = _log_sum(alpha[:, t - 1, :, None] + move[None, :-1], 1) + scores[:, t]
            alpha[:, t] = np.where(inside[:, t, None], new, alpha[:, t - 1])
        for t in range(steps_max - 2, -1, -1):
            new = _log_sum(move[None, :-1] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(inside[:, t + 1, None], new, 0.0)
        total = _log_sum(alpha[np.arange(n), size - 1], 1)
        marginal = np.exp(alpha + beta - total[:, None, None]) * inside[:, :, None]
        expected = np.zeros((k + 1, k))
        expected[-1] = marginal[:, 0].sum(0)
        for t in range(1, steps_max):
            pair = alpha[:, t - 1, :, None] + move[None, :-1] + (scores[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
            expected[:-1] += (np.exp(pair) * inside[:, t, None, None]).sum(0)
        error = (one_hot - marginal).reshape(-1, k)
        de = np.stack([np.bincount(spot[:, 1], weights=error[spot[:, 0], b], minlength=len(features)) for b in range(k)], 1) - decay * n * emit
        dm = np.where(bad, 0.0, true_move - expected - decay * n * np.where(bad, 0, move))
        ge += de * de
        gm += dm * dm
        emit += rate * de / np.sqrt(ge)
        move += rate * dm / np.sqrt(gm)
    return Field(features, emit, move)


# ---------------------------------------------------------------- whole texts

_TRIGGER = re.compile(r"[0-9@]|[\[({](?:at|dot)[\])}]", re.I)
_WORD = re.compile(r"\S+")
_TRIM = re.compile(r"[^\W_]|[+(\[]")


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Word places of the stretches within ``REACH`` words of a trigger; touching stretches are one."""
    out: list[list[tuple[int, int]]] = []
    found = _TRIGGER.search(text)
    ahead: list[tuple[int, int]] = []
    while found:
        start = found.start()
        floor = out[-1][-1][1] if out else 0
        while start > floor and not text[start - 1].isspace():
            start -= 1
        # Words before the trigger's word, at most REACH of them, not earlier than the last window's end.
        place, before = start, []
        while len(before) < REACH and place > floor:
            stop = place
            while stop > floor and text[stop - 1].isspace():
                stop -= 1
            place = stop
            while place > floor and not text[place - 1].isspace():
                place -= 1
            if place < stop:
                before.append((place, stop))
        ahead, since, at = before[::-1], 0, start
        while since <= REACH:
            word = _WORD.search(text, at)
            if word is None:
                break
            since = 0 if _TRIGGER.search(text, word.start(), word.end()) else since + 1
            ahead.append(word.span())
            at = word.end()
        out.append(ahead)
        found = _TRIGGER.search(text, at)
    return out


#: Characters up to which a word is taken as it is.
LONG = 60
_PIECE = re.compile(r"[+(]{0,2}[0-9][0-9().+/\-]{0,57}|(?:(?![+(]{0,2}[0-9]).){1,60}", re.S)


def pieces(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The places of a long word's numbers and of what stands between them; a word of up to ``LONG`` characters is one piece."""
    return [(start, end)] if end - start <= LONG else [m.span() for m in _PIECE.finditer(text, start, end)]


def _trim(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and not (text[start].isalnum() or text[start] in "+(["):
        start += 1
    while end > start and not (text[end - 1].isalnum() or text[end - 1] in ")]"):
        end -= 1
    return start, end


def added_spans(field: Field, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans of the field in every text, without those that overlap a base span of the text."""
    own, sequences, places = [], [], []
    for k, text in enumerate(texts):
        if _TRIGGER.search(text):
            for window in windows(text):
                window = [piece for a, b in window for piece in pieces(text, a, b)]
                own.append(k)
                places.append(window)
                sequences.append([text[a:b] for a, b in window])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, window, labels in zip(own, places, field.decode(sequences), strict=True):
        at = 0
        while at < len(labels):
            if labels[at] == 0:
                at += 1
                continue
            kind, stop = LABELS[labels[at]][2:], at + 1
            while stop < len(labels) and LABELS[labels[stop]] == f"I-{kind}":
                stop += 1
            start, end = _trim(texts[k], window[at][0], window[stop - 1][1])
            if end > start and not any(a < end and start < b for a, _, b in base[k]):
                out[k].append((start, KINDS.index(kind), end))
            at = stop
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, base, added``: arrays of spans ``(start, kind, end)`` in code points, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span = "array<struct<start:int,kind:string,end:int>>"

    def work(part: pd.DataFrame) -> pd.DataFrame:
        texts = list(part["text"])
        base = [base_spans(t) for t in texts]
        added = added_spans(shared.value, texts, base)
        named = lambda found: [{"start": a, "kind": KINDS[k], "end": b} for a, k, b in found]
        return pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "base": [named(x) for x in base], "added": [named(x) for x in added]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), work, f"doc_id {kind}, base {span}, added {span}")


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; null texts stay null.

    Overlapping base spans are replaced as one, by the kind that starts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for start, kind, end in sorted(spans):
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            missing = batch["text"].isna()
            for part in slices([batch]):
                texts = list(part["text"])
                base = [base_spans(t) for t in texts]
                added = added_spans(shared.value, texts, base)
                new = [clean(t, a + b) for t, a, b in zip(texts, base, added, strict=True)]
                yield part.assign(text=pd.Series(new, index=part.index, dtype=object).where(~missing.loc[part.index], None))

    return docs.mapInPandas(run, docs.schema)


def with_kind(array: str, kind: str) -> Column:
    return F.size(F.filter(array, lambda s: s["kind"] == kind)).cast("long")


def listed(array) -> Column:
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
