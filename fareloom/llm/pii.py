"""Personal data by rules and a semi-Markov conditional random field.

The rules find e-mail addresses, network addresses, card numbers and phone numbers of fixed
forms; what they find always stays. The random field adds spans that the rules' forms miss: it
scores whole candidate segments (shape, digit groups, checksum, length, words before, how
the segment meets its neighbours) and a dynamic program over segments of at most ``LONGEST``
atoms chooses boundaries and kinds together.

An atom is a run of letters, a run of digits or a single other character. A candidate holds an @ or
the word "at", or no letter and seven digits or four digits and three dots. So only the surroundings of
digits, @ and "at" are looked at, as far as a candidate with one of them and the features of it can reach.
Elsewhere every atom is outside any entity, so the program over these regions is the one over the text.

The weights are fitted on the driver by stochastic gradient ascent of the likelihood, from at
most ``regions`` (1,200) regions of at most ``REGION_CHARS`` characters, the first in the order of
a seeded hash. The rules label them; every entity is also shown in forms that the rules miss,
with the same label, and every region with an "at" that belongs to none. Finding is a pass without shuffles over every text whole.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import pieces, ship, strings

#: The kinds in the order in which they are reported, and their forms.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LONGEST = 16
REGIONS = 1200
REGION_CHARS = 300
#: Atoms before and after a hint that belong to its region: a candidate's other atoms, the words that its
#: features look at before it, and the two characters after it.
BEFORE, AFTER = LONGEST - 1 + 3, LONGEST - 1 + 2
#: What every candidate holds one of.
_HINT = re.compile(r"[0-9]+|@|(?<![^\W\d_])[Aa][Tt](?![^\W\d_])")
_ATOM = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"[._-]?[0-9]+")

Span = tuple[str, int, int]


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    return len(part := part.lstrip("0")) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """What the rules find, each kind leftmost and without overlaps, in order of start and kind.

    Every pattern is matched in time linear in the text: an address is found from its @, a run
    of digits is entered at its first digit only.
    """
    out = []
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append(("email", start, end := m.end()))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of the text around its digits, @ and the word "at"; those that touch are one."""
    if not _HINT.search(text):
        return
    atoms = [m.span() for m in _ATOM.finditer(text)]
    starts = [a for a, _ in atoms]
    begin, end = 0, None
    for m in _HINT.finditer(text):
        n = bisect_left(starts, m.start())
        first = starts[n - BEFORE] if n > BEFORE else 0
        if end is not None and first > end:
            yield begin, end
            end = None
        if end is None:
            begin = first
        end = atoms[n + AFTER][1] if n + AFTER < len(atoms) else len(text)
    if end is not None:
        yield begin, end


#: What a segment's inside looks like: digits, marks, letter runs (6 at most), atoms, lengths of digit groups, first atom,
#: checksum, whether its groups are bytes, words "at" and signs @, length of the last atom, whether it holds a blank, and an @.
Shape = tuple


def shape_features(shape: Shape) -> list[str]:
    d, marks, letters, atoms, groups, first, checked, small, ats, last, spaced, sign = shape
    out = ["bias", f"digits={d}", f"marks={marks}", f"letters={letters}", f"atoms={atoms}"]
    out += [f"groups={'-'.join(map(str, groups))}", f"first={first}"]
    if checked is not None:
        out.append(f"luhn={checked}")
    if small is not None:
        out.append(f"bytes={small},{marks}")
    if letters:
        out += [f"ats={ats},last={last}", f"spaced={spaced},{sign}"]
    return out


class Lattice:
    """Atoms of a region and its candidate segments.

    The features of a segment are those of its shape, of what is before its first and of what is after its last
    atom, so each part is known once for all segments that share it. ``closed`` spans are not looked into.
    """

    def __init__(self, text: str, closed: list[Span] = ()):
        self.text = text
        self.atoms = found = [m.span() for m in _ATOM.finditer(text)]
        self.word = word = [text[a:b] for a, b in found]
        n = len(word)
        self.digit = [w[0] in "0123456789" for w in word]
        self.alpha = [w[0].isalpha() for w in word]
        self.solid = [w[0].isalnum() for w in word]
        self.at = [w == "@" or w.lower() == "at" for w in word]
        self.blank, barred = [False] * n, [False] * n
        for k in range(1, n):
            gap = text[found[k - 1][1] : found[k][0]]
            self.blank[k], barred[k] = " " in gap, "\n" in gap
        taken = [any(a < e and s < b for _, s, e in closed) for a, b in found] if closed else [False] * n
        #: First atom that no segment from here may hold, and the first run of letters.
        self.wall, self.letter = [n] * (n + 1), [n] * (n + 1)
        for k in range(n - 1, -1, -1):
            self.letter[k] = k if self.alpha[k] else self.letter[k + 1]
            self.wall[k] = k if taken[k] else k + 1 if k + 1 < n and barred[k + 1] else self.wall[k + 1]
        self.digits, self.ats = [0], [0]
        for k, w in enumerate(word):
            self.digits.append(self.digits[-1] + len(w) * self.digit[k])
            self.ats.append(self.ats[-1] + self.at[k])

    def segments(self, i: int) -> list[tuple[int, Shape]]:
        """(end, shape) of every candidate that begins at an atom."""
        word, solid, digit, alpha = self.word, self.solid, self.digit, self.alpha
        if not solid[i] and word[i] not in "+([":
            return []
        stop = min(self.wall[i], i + LONGEST)
        if self.ats[stop] == self.ats[i]:  # then it can hold no letters, and needs digits
            stop = min(stop, self.letter[i])
            if self.digits[stop] - self.digits[i] < 4:
                return []
        first = word[i] if not word[i].isalnum() else "a" if alpha[i] else "9"
        out, marks, spaced, sign, letters, dots, groups = [], "", False, False, 0, 0, ()
        for k in range(i, stop):
            w = word[k]
            if self.blank[k] and k > i and not spaced:
                spaced, marks = True, "".join(sorted(marks + " "))
            if alpha[k]:
                letters += 1
            elif digit[k]:
                groups += (len(w),)
            elif not solid[k]:
                dots += w == "."
                sign = sign or w == "@"
                if w not in marks:
                    marks = "".join(sorted(marks + w))
            if not solid[k]:
                continue
            ats, d = self.ats[k + 1] - self.ats[i], self.digits[k + 1] - self.digits[i]
            if letters:
                if ats:
                    out.append((k + 1, (d, marks, letters if letters < 6 else 6, k + 1 - i, (), first, None, None, ats, min(len(w), 5), spaced, sign)))
            elif ats or d >= 7 or d >= 4 and dots >= 3:
                checked = luhn("".join(word[x] for x in range(i, k + 1) if digit[x])) if 12 <= d <= 19 else None
                small = all(_byte(word[x]) for x in range(i, k + 1) if digit[x]) if len(groups) == 4 else None
                out.append((k + 1, (d, marks, 0, k + 1 - i, groups[:6], first, checked, small, 0, 0, False, False)))
        return out

    def before(self, i: int) -> list[str]:
        a = self.atoms[i][0]
        left = self.text[a - 1] if a else "^"
        words = [self.word[k].lower() for k in range(max(0, i - 3), i) if self.alpha[k]]
        return [f"left={'a' if left.isalnum() else left if left in '+.-@(_%/' else ' '}", *(f"word={w}" for w in words[-2:])]

    def after(self, j: int) -> list[str]:
        text, b = self.text, self.atoms[j - 1][1]
        right = text[b] if b < len(text) else "$"
        more = b + 1 < len(text)
        beyond = right in ".-)@," and more and text[b + 1].isalnum()
        out = [f"right={'a' if right.isalnum() else right if beyond else ' '}"]
        return [*out, "digits follow"] if right == " " and more and text[b + 1].isdigit() else out


class SemiMarkov:
    """Weights per feature and kind; atoms outside entities score zero."""

    #: Shapes whose weights are kept.
    KEPT = 100_000

    def __init__(self, weights: dict[str, list[float]] | None = None):
        self.weights = weights or {}
        self.shapes: dict[Shape, list[float]] = {}

    def _sum(self, features: list[str]) -> list[float]:
        found = [w for f in features if (w := self.weights.get(f))]
        return [sum(c) for c in zip(*found)] if found else [0.0] * len(KINDS)

    def _shape(self, shape: Shape) -> list[float]:
        if (known := self.shapes.get(shape)) is None:
            if len(self.shapes) >= self.KEPT:
                self.shapes.clear()
            known = self.shapes[shape] = self._sum(shape_features(shape))
        return known

    def best(self, lattice: Lattice) -> list[Span]:
        """The segments of the highest total score; what is kept per atom is one total and one segment."""
        n = len(lattice.atoms)
        total, came = [-math.inf] * (n + 1), [None] * (n + 1)
        after: dict[int, list[float]] = {}
        total[0] = 0.0
        for i in range(n):
            if i and total[i - 1] >= total[i]:
                total[i], came[i] = total[i - 1], None
            if not (found := lattice.segments(i)):
                continue
            before = self._sum(lattice.before(i))
            for j, shape in found:
                if (right := after.get(j)) is None:
                    right = after[j] = self._sum(lattice.after(j))
                scores = [x + y + z for x, y, z in zip(before, self._shape(shape), right)]
                top = max(scores)
                if total[i] + top > total[j]:
                    total[j], came[j] = total[i] + top, (i, scores.index(top))
            after.pop(i, None)
        if n and total[n - 1] >= total[n]:
            came[n] = None
        out, j = [], n
        while j:
            if came[j]:
                i, kind = came[j]
                out.append((KINDS[kind], lattice.atoms[i][0], lattice.atoms[j - 1][1]))
                j = i
            else:
                j -= 1
        return out[::-1]

    def fit(self, examples: list[tuple[str, list[Span]]], passes: int = 4, rate: float = 0.5, decay: float = 0.002) -> SemiMarkov:
        """Ascend the likelihood, one example at a time with steps that shrink per weight."""
        number: dict[str, int] = {}
        known = [Example(Lattice(text), set(gold), number) for text, gold in examples]
        weights, seen = np.zeros((len(number), len(KINDS))), np.ones((len(number), len(KINDS)))
        for _ in range(passes):
            for example in known:
                at, g = example.slopes(weights)
                g = g - decay * weights[at]
                seen[at] += g * g
                weights[at] += rate * g / np.sqrt(seen[at])
        self.weights = {f: weights[n].tolist() for f, n in number.items() if weights[n].any()}
        self.shapes.clear()
        return self


def _added(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms))


class Example:
    """A lattice with its right segmentation, laid out for repeated likelihoods; ``number`` gives new features a place."""

    def __init__(self, lattice: Lattice, gold: set[Span], number: dict[str, int]):
        self.atoms = n = len(lattice.atoms)
        parts: dict[tuple, int] = {}
        features: list[list[int]] = []

        def part(key: tuple, names: Callable[[], list[str]]) -> int:
            if key not in parts:
                parts[key] = len(features)
                features.append([number.setdefault(f, len(number)) for f in names()])
            return parts[key]

        rows, self.gold = [], []
        for i in range(n):
            for j, shape in lattice.segments(i):
                of = (
                    part(("before", i), lambda i=i: lattice.before(i)),
                    part(("shape", shape), lambda shape=shape: shape_features(shape)),
                    part(("after", j), lambda j=j: lattice.after(j)),
                )
                span = lattice.atoms[i][0], lattice.atoms[j - 1][1]
                rows.append((i, j, *of))
                self.gold.append([float((k, *span) in gold) for k in KINDS])
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.begin, self.end, self.parts = table[:, 0], table[:, 1], table[:, 2:]
        self.gold = np.array(self.gold).reshape(-1, len(KINDS))
        self.flat = np.array([f for names in features for f in names], np.int64)
        self.sizes = np.array([len(names) for names in features], np.int64)
        self.touched, self.place = np.unique(self.flat, return_inverse=True)

    def _totals(self, weights: np.ndarray) -> tuple[np.ndarray, list[float], list[float]]:
        """Scores per segment and kind, and logarithms of the summed weights of all ways to and from every place."""
        starts = np.cumsum(self.sizes) - self.sizes
        part = np.add.reduceat(weights[self.flat], starts) if len(self.flat) else np.zeros((0, len(KINDS)))
        scores = part[self.parts].sum(axis=1)
        any_kind = np.logaddexp.reduce(scores, axis=1).tolist()
        n = self.atoms
        fore, into = [0.0] * (n + 1), [[] for _ in range(n + 1)]
        back, out = [0.0] * (n + 1), [[] for _ in range(n + 1)]
        ways = list(zip(self.begin.tolist(), self.end.tolist(), any_kind))
        at = 0
        for i in range(n + 1):
            if i:
                fore[i] = _added([fore[i - 1], *into[i]]) if into[i] else fore[i - 1]
            while at < len(ways) and ways[at][0] == i:
                into[ways[at][1]].append(fore[i] + ways[at][2])
                out[i].append(ways[at])
                at += 1
        for i in range(n - 1, -1, -1):
            back[i] = _added([back[i + 1], *(back[j] + s for _, j, s in out[i])]) if out[i] else back[i + 1]
        return scores, fore, back

    def likelihood(self, weights: np.ndarray) -> float:
        """Logarithm of the right segmentation's share among all segmentations."""
        scores, fore, _ = self._totals(weights)
        return float((scores * self.gold).sum()) - fore[-1]

    def slopes(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features and what the likelihood gains per feature and kind."""
        scores, fore, back = self._totals(weights)
        share = np.exp(np.array(fore)[self.begin, None] + scores + np.array(back)[self.end, None] - fore[-1])
        off = self.gold - share
        off[np.abs(off) <= 1e-4] = 0
        part = np.zeros((len(self.sizes), len(KINDS)))
        for column in self.parts.T:
            np.add.at(part, column, off)
        step = np.zeros((len(self.touched), len(KINDS)))
        np.add.at(step, self.place, np.repeat(part, self.sizes, axis=0))
        moved = step.any(axis=1)
        return self.touched[moved], step[moved]


def disguised(kind: str, text: str, rng: random.Random) -> str:
    """A form of an entity that the rules do not know."""
    if kind == "email":
        name, _, domain = rng.choice([text, _NUMBER.sub("", text)]).partition("@")  # often without digits
        if not name or not domain.strip("."):
            name, _, domain = text.partition("@")
        return rng.choice([f"{name} at {domain}", f"{name} [at] {domain}", f"{name}(at){domain}", f"{name} @ {domain}"])
    if kind == "ip":
        return rng.choice([text.replace(".", "[.]"), text.replace(".", " . ")])
    digits = _digits(text)
    if kind == "card":
        mark = rng.choice([".", "/", "  "])
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    digits = rng.choice([digits, digits[-10:], digits[-10:]])  # often without the country
    cut = rng.choice([(3, 3), (3, 3), (2, 4), (4, 3)])
    parts = [digits[: cut[0]], digits[cut[0] : sum(cut)], digits[sum(cut) :]]
    return rng.choice(["({}) {}-{}", "{}-{}-{}", "{} {} {}", "{}.{}.{}", "00{} {} {}"]).format(*parts)


def examples(texts: list[str], seed: int = 5) -> list[tuple[str, list[Span]]]:
    """Each text with the rules' labels, with each of its entities disguised in turn, and with a plain "at" put in."""
    rng, out = random.Random(seed), []
    for text in texts:
        gold = base_spans(text)
        if any(a[2] > b[1] for a, b in zip(gold, gold[1:])):
            continue  # kinds that overlap leave no single right answer
        out.append((text, gold))
        for n, (kind, start, end) in enumerate(gold):
            new = disguised(kind, text[start:end], rng)
            shift = len(new) - (end - start)
            moved = [*gold[:n], (kind, start, start + len(new)), *((k, s + shift, e + shift) for k, s, e in gold[n + 1 :])]
            out.append((text[:start] + new + text[end:], moved))
        blanks = [p for p, c in enumerate(text) if c == " " and not any(s <= p <= e for _, s, e in gold)]
        if blanks:
            p = rng.choice(blanks)
            out.append((text[:p] + " at" + text[p:], [(k, s + 3 * (s > p), e + 3 * (s > p)) for k, s, e in gold]))
    return out


def learn(docs: DataFrame, text_col: str = "text", most: int = REGIONS, seed: int = 5) -> dict[str, list[float]]:
    """Weights of the random field from a bounded sample of the regions in ``docs``; none if there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = {t[a : min(b, a + REGION_CHARS)] for t in strings(batch.column("text")) for a, b in regions(t)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["region"])

    ship(docs.sparkSession)
    cut = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "region string")
    first = cut.distinct().orderBy(F.xxhash64(F.lit(seed), "region"), "region").limit(most)
    return SemiMarkov().fit(examples([r.region for r in first.collect()], seed)).weights


def find(docs: DataFrame, weights: dict[str, list[float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and spans (kind, start, end, base), by start, then kind.

    Places are code points, the end exclusive. ``base`` marks what the rules found; the added
    spans overlap neither those nor each other. A missing or empty text has no spans.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(weights)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def spans(text: str, model: SemiMarkov) -> list[dict]:
        if not _HINT.search(text):
            return []
        base = base_spans(text)
        out = [(*s, True) for s in base]
        for a, b in regions(text) if model.weights else ():
            near = [(k, s - a, e - a) for k, s, e in base if s < b and e > a]
            out += [(k, s + a, e + a, False) for k, s, e in model.best(Lattice(text[a:b], near))]
        out.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
        return [dict(zip(("kind", "start", "end", "base"), s)) for s in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SemiMarkov(held.value)
        for batch in pieces(batches, "text"):
            found = [spans(t, model) for t in strings(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")
