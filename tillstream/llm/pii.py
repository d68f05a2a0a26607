"""Personal data: patterns, and a conditional random field that adds to them."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.pii_examples import EXAMPLES

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # place of the kind in KINDS, start, end

# The patterns of the four kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# IPs, cards and phone numbers lie within one such run, so texts are searched there only.
_NUMBERS = re.compile(r"[+0-9][0-9\x20().+-]*")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        twice = int(digit) << (k & 1)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    parts = re.findall("[0-9]+", text)
    parts = [p.lstrip("0") or "0" for p in parts]
    return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = "".join(_DIGITS.findall(text))
    return 12 <= len(digits) <= 19 and luhn(digits)


def _digit_count(text: str) -> int:
    return len(_DIGITS.findall(text))


def _emails(text: str) -> Iterator[Span]:
    """As EMAIL.finditer, without trying at every letter: each match surrounds an @."""
    free, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > free:
            # Step back over the local part in growing pieces; it has no length limit.
            piece = _LOCAL_PART.search(text, max(free, low - 64), low)
            if piece is None:
                break
            low = piece.start()
            if low > max(free, piece.endpos - 64):
                break
        match = EMAIL.match(text, low) if low < at else None
        free = match.end() if match else at + 1
        if match:
            yield 0, match.start(), match.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """What the patterns find, leftmost and non-overlapping for each kind."""
    found = list(_emails(text)) if "@" in text else []
    for run in _NUMBERS.finditer(text):
        low, high = run.span()
        if high - low < 7:
            continue  # shorter than 0.0.0.0
        for m in IP.finditer(text, low, high):
            if _is_ip(m.group()):
                found.append((1, *m.span()))
        for m in CARD.finditer(text, low, high):
            if _is_card(m.group()):
                found.append((2, *m.span()))
        for m in PHONE.finditer(text, low, high):
            if 9 <= _digit_count(m.group()) <= 15:
                found.append((3, *m.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


# ── Conditional random field ─────────────────────────────────────────────────
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
_MARK = re.compile(r"\[(email|ip|card|phone)\|((?:[^][]|\[[^]]*\])*)\]")
# Personal data holds a digit, an @ or the word "at" (see _CHECKS). Tokens this many
# characters around one, and around "dot", are decoded first, as a chain. A chain with a
# span near its end is decoded again with twice the reach, so no span ends with a chain.
_ANCHOR = re.compile(r"[0-9]+|@|\b(?i:at|dot)\b")
REACH = 32
MARGIN = 6  # tokens outside any span at a chain's ends, unless the text ends there
# Characters that are decoded at a time: so many of short chains together, and of a long
# chain a piece, which ends where no span is. Features see so many beyond a piece's ends.
PIECE = 1 << 15
AROUND = 512
MOST_PADDED = 1 << 16  # tokens of chains that are decoded together, padding included
OUTSIDE = 0
LABELS = 1 + 2 * len(KINDS)  # outside, then first and later token of each kind


def _shape(token: str) -> str:
    if "0" <= token[0] <= "9":
        return f"d{min(len(token), 20)}"
    if token[0].isalpha():
        case = "X" if token.isupper() else "Xx" if token[0].isupper() else "x"
        return case + str(min(len(token), 4))
    return token


def token_features(text: str, tokens: list[tuple[int, int]]) -> list[list[str]]:
    """Word-shape features of each token and its neighbours in a chain."""
    shapes, words, glued = [], [], []
    for k, (low, high) in enumerate(tokens):
        word = text[low:high]
        shapes.append(_shape(word))
        words.append(word.lower() if word[0].isalpha() and len(word) <= 10 else "")
        glued.append(k > 0 and tokens[k - 1][1] == low)
    # Whether the digits of a run of numbers and separators pass as a card.
    passes = [False] * len(tokens)
    k = 0
    while k < len(tokens):
        end, digits = k, ""
        while end < len(tokens) and (shapes[end][0] == "d" or (shapes[end] in "-./" and digits)):
            if shapes[end][0] == "d":
                digits += text[tokens[end][0] : tokens[end][1]]
            end += 1
        if 12 <= len(digits) <= 19 and luhn(digits):
            passes[k:end] = [True] * (end - k)
        k = max(end, k + 1)

    def at(values: list, k: int, none: object) -> object:
        return values[k] if 0 <= k < len(values) else none

    found = []
    for k in range(len(tokens)):
        own = ["bias", f"s0={shapes[k]}", f"c={passes[k]}{shapes[k][0] == 'd'}"]
        own.append(f"g={glued[k]}{at(glued, k + 1, False)}{shapes[k][:1]}")
        for step in (-2, -1, 1, 2):
            own.append(f"s{step}={at(shapes, k + step, '|')}")
        own.append(f"s-10={at(shapes, k - 1, '|')},{shapes[k]}")
        own.append(f"s01={shapes[k]},{at(shapes, k + 1, '|')}")
        own.append(f"s-101={at(shapes, k - 1, '|')},{shapes[k]},{at(shapes, k + 1, '|')}")
        for step in (-2, -1, 0, 1):
            if word := at(words, k + step, ""):
                own.append(f"w{step}={word}")
        found.append(own)
    return found


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


class ChainModel:
    """A linear-chain CRF: feature weights by label, and weights of label pairs."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, steps: np.ndarray) -> None:
        self.index, self.weights, self.steps = index, weights, steps

    def scores(self, features: list[list[str]]) -> np.ndarray:
        """Score of each label at each token."""
        known = [[self.index[f] for f in own if f in self.index] for own in features]
        return np.array([self.weights[own].sum(axis=0) for own in known])

    def decode(self, chains: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi over many chains at once, those of similar length together."""
        order = sorted(range(len(chains)), key=lambda k: len(chains[k]))
        best: list[np.ndarray] = [np.zeros(0, int)] * len(chains)
        for group in _alike(order, [len(c) for c in chains]):
            longest = len(chains[group[-1]])
            count = len(group)
            lengths = np.array([len(chains[k]) for k in group])
            padded = np.zeros((count, longest, LABELS))
            for row, k in enumerate(group):
                padded[row, : lengths[row]] = chains[k]
            score = padded[:, 0] + _START
            back = np.zeros((longest, count, LABELS), dtype=np.int8)
            for t in range(1, longest):
                paths = score[:, :, None] + self.steps[None]
                back[t] = paths.argmax(axis=1)
                moved = paths.max(axis=1) + padded[:, t]
                going = t < lengths
                score = np.where(going[:, None], moved, score)
            label = score.argmax(axis=1)
            path = np.zeros((count, longest), dtype=np.int8)
            for t in range(longest - 1, -1, -1):
                path[:, t] = label
                inside = (t < lengths) & (t > 0)
                label = np.where(inside, back[t, np.arange(count), label], label)
            for row, k in enumerate(group):
                best[k] = path[row, : lengths[row]]
        return best


def _alike(order: list[int], lengths: list[int]) -> Iterator[list[int]]:
    """Chains in order of length, as many at a time as ``MOST_PADDED`` has room for."""
    low = 0
    while low < len(order):
        high = low + 1
        while high < len(order) and lengths[order[high]] * (high + 1 - low) <= MOST_PADDED:
            high += 1
        yield order[low:high]
        low = high


def _possible() -> tuple[np.ndarray, np.ndarray]:
    """Later tokens of a kind follow tokens of that kind only."""
    start = np.zeros(LABELS)
    steps = np.zeros((LABELS, LABELS))
    for kind in range(len(KINDS)):
        first, later = 1 + 2 * kind, 2 + 2 * kind
        start[later] = -1e4
        steps[:, later] = -1e4
        steps[first, later] = steps[later, later] = 0.0
    return start, steps


_START, _STEPS = _possible()


def _read_marks(example: str) -> tuple[str, list[Span]]:
    text, spans, done = "", [], 0
    for mark in _MARK.finditer(example):
        text += example[done : mark.start()]
        spans.append((KINDS.index(mark.group(1)), len(text), len(text) + len(mark.group(2))))
        text += mark.group(2)
        done = mark.end()
    return text + example[done:], spans


def train(examples: Iterable[str] = EXAMPLES, rounds: int = 200, penalty: float = 0.02) -> ChainModel:
    """Fit by gradient steps on the log likelihood of all examples together."""
    features, labels = [], []
    for example in examples:
        text, spans = _read_marks(example)
        tokens = [m.span() for m in _TOKEN.finditer(text)]
        own = np.zeros(len(tokens), dtype=int)
        for kind, low, high in spans:
            inside = [k for k, t in enumerate(tokens) if t[0] >= low and t[1] <= high]
            own[inside] = 2 + 2 * kind
            own[inside[:1]] = 1 + 2 * kind
        if len(tokens):
            features.append(token_features(text, tokens))
            labels.append(own)
    index = {f: k for k, f in enumerate(dict.fromkeys(f for s in features for o in s for f in o))}
    weights, steps = np.zeros((len(index), LABELS)), np.zeros((LABELS, LABELS))
    if not labels:
        weights = np.zeros((1, LABELS))
        weights[0, OUTSIDE] = 1.0
        return ChainModel({"bias": 0}, weights, _STEPS)
    count, longest = len(labels), max(map(len, labels))
    lengths = np.array([len(x) for x in labels])
    inside = np.arange(longest)[None] < lengths[:, None]
    wanted = np.zeros((count, longest, LABELS))
    wanted_steps = np.zeros((LABELS, LABELS))
    rows, tokens_at, ids = [], [], []
    for row, (sentence, own) in enumerate(zip(features, labels, strict=True)):
        wanted[row, np.arange(len(own)), own] = 1
        np.add.at(wanted_steps, (own[:-1], own[1:]), 1)
        for t, fs in enumerate(sentence):
            rows += [row] * len(fs)
            tokens_at += [t] * len(fs)
            ids += [index[f] for f in fs]
    rows, tokens_at, ids = np.array(rows), np.array(tokens_at), np.array(ids)
    grown_w, grown_s = np.full_like(weights, 1e-6), np.full_like(steps, 1e-6)
    for _ in range(rounds):
        score = np.zeros((count, longest, LABELS))
        np.add.at(score, (rows, tokens_at), weights[ids])
        moves = steps + _STEPS
        ahead = np.zeros_like(score)
        ahead[:, 0] = score[:, 0] + _START
        for t in range(1, longest):
            ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + moves[None], 1) + score[:, t]
        total = _log_sum(ahead[np.arange(count), lengths - 1], 1)
        behind = np.zeros_like(score)
        for t in range(longest - 2, -1, -1):
            nxt = _log_sum(moves[None] + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where((t + 1 < lengths)[:, None], nxt, 0.0)
        share = np.exp(ahead + behind - total[:, None, None]) * inside[:, :, None]
        pairs = np.zeros((LABELS, LABELS))
        for t in range(1, longest):
            joint = (
                ahead[:, t - 1, :, None]
                + moves[None]
                + (score[:, t] + behind[:, t])[:, None, :]
                - total[:, None, None]
            )
            pairs += (np.exp(joint) * (t < lengths)[:, None, None]).sum(axis=0)
        slope_w = np.zeros_like(weights)
        np.add.at(slope_w, ids, (wanted - share)[rows, tokens_at])
        slope_w -= penalty * weights
        slope_s = wanted_steps - pairs - penalty * steps
        grown_w += slope_w**2
        grown_s += slope_s**2
        weights += 0.3 * slope_w / np.sqrt(grown_w)
        steps += 0.3 * slope_s / np.sqrt(grown_s)
    return ChainModel(index, weights, steps + _STEPS)


def _same_token(one: str, two: str) -> bool:
    if "0" <= one <= "9" or "0" <= two <= "9":
        return "0" <= one <= "9" and "0" <= two <= "9"
    return all(c.isalnum() and not c.isdecimal() for c in (one, two))


def _whole(text: str, low: int, high: int) -> tuple[int, int]:
    """The stretch with the tokens at its ends made whole."""
    low, high = max(low, 0), min(high, len(text))
    while 0 < low < len(text) and _same_token(text[low - 1], text[low]):
        low -= 1
    while 0 < high < len(text) and _same_token(text[high - 1], text[high]):
        high += 1
    return low, high


def _merged(text: str, stretches: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches in order of start, those that meet as one, ending at token borders."""
    found: list[list[int]] = []
    for low, high in stretches:
        if found and low <= found[-1][1]:
            found[-1][1] = max(found[-1][1], high)
        else:
            found.append([low, high])
    whole: list[tuple[int, int]] = []
    for low, high in (_whole(text, *f) for f in found):
        if whole and low <= whole[-1][1]:
            before = whole.pop()
            low, high = before[0], max(before[1], high)
        whole.append((low, high))
    return whole


def chains_of(text: str) -> list[tuple[int, int]]:
    """Stretches around all that personal data must hold; each is a chain of tokens."""
    return _merged(text, ((m.start() - REACH, m.end() + REACH) for m in _ANCHOR.finditer(text)))


# What a span found by the model must hold to count.
_CHECKS = (
    lambda s: re.search(r"@|\bat\b", s, re.I) is not None and _has_ends(s),
    _is_ip,
    _is_card,
    lambda s: 7 <= _digit_count(s) <= 15,
)


def _has_ends(text: str) -> bool:
    return text[0].isalnum() and text[-1].isalnum() and len(text) >= 5


def _label_spans(tokens: list[tuple[int, int]], path: np.ndarray) -> list[Span]:
    found, t = [], 0
    while t < len(path):
        if path[t] == OUTSIDE or path[t] % 2 == 0:
            t += 1
            continue
        end = t + 1
        while end < len(path) and path[end] == path[t] + 1:
            end += 1
        found.append(((int(path[t]) - 1) // 2, tokens[t][0], tokens[end - 1][1]))
        t = end
    return found


def _ends_open(text: str, stretch: tuple[int, int], path: np.ndarray) -> bool:
    """Whether more text might continue a span at either end."""
    low, high = stretch
    return (low > 0 and bool(path[:MARGIN].any())) or (
        high < len(text) and bool(path[-MARGIN:].any())
    )


def _long_chain(text: str, stretch: tuple[int, int], model: ChainModel) -> tuple[list[Span], bool]:
    """Spans of a long chain, decoded piece by piece, and whether its ends are open.

    A piece ends within tokens that its best path leaves outside any span; the next one
    begins there with that label, as the best path of both together would.
    """
    low, high = stretch
    found, begin, size, is_open = [], low, PIECE, False
    while begin < high:
        end = _whole(text, begin, min(begin + size, high))[1]
        seen = _whole(text, max(begin - AROUND, low), min(end + AROUND, high))
        tokens = [m.span() for m in _TOKEN.finditer(text, *seen)]
        first = bisect_left(tokens, (begin, 0))
        last = bisect_left(tokens, (end, 0))
        if first == last:
            begin = end
            continue
        scores = model.scores(token_features(text, tokens))[first:last]
        tokens = tokens[first:last]
        if begin > low:
            scores[0, np.arange(LABELS) != OUTSIDE] = -1e9
        (path,) = model.decode([scores])
        stop = len(path)
        if end < high:
            stop = _quiet(path)
            if stop is None:
                size *= 2
                continue
        if begin == low and low > 0:
            is_open = bool(path[:MARGIN].any())
        if end >= high and high < len(text):
            is_open = is_open or bool(path[-MARGIN:].any())
        found += _label_spans(tokens, path[:stop])
        begin, size = tokens[stop][0] if stop < len(path) else high, PIECE
    return found, is_open


def _quiet(path: np.ndarray) -> int | None:
    """The middle of the last long enough run of tokens outside, in the second half."""
    width, half = 2 * MARGIN, len(path) // 2
    inside = np.concatenate([[0], np.cumsum(path != OUTSIDE)])
    runs = np.flatnonzero(inside[width:] == inside[:-width])
    runs = runs[runs >= half]
    return int(runs[-1]) + MARGIN if len(runs) else None


def _decoded(
    texts: list[str], work: list[tuple[int, tuple[int, int]]], model: ChainModel
) -> Iterator[tuple[int, tuple[int, int], list[Span], bool]]:
    """Each chain with its spans and whether its ends are open; short ones together."""
    group: list[tuple[int, tuple[int, int]]] = []

    def together() -> Iterator[tuple[int, tuple[int, int], list[Span], bool]]:
        tokens = [[m.span() for m in _TOKEN.finditer(texts[k], *stretch)] for k, stretch in group]
        scored = [model.scores(token_features(texts[k], t)) for (k, _), t in zip(group, tokens, strict=True)]
        for (k, stretch), own, path in zip(group, tokens, model.decode(scored), strict=True):
            yield k, stretch, _label_spans(own, path), _ends_open(texts[k], stretch, path)

    held = 0
    for k, stretch in work:
        chars = stretch[1] - stretch[0]
        if chars > PIECE:
            yield k, stretch, *_long_chain(texts[k], stretch, model)
            continue
        if held + chars > PIECE:
            yield from together()
            group, held = [], 0
        group.append((k, stretch))
        held += chars
    if group:
        yield from together()


def model_spans(texts: list[str], model: ChainModel) -> list[list[Span]]:
    """Spans the model finds in each text, before any comparison with the patterns."""
    found: list[list[Span]] = [[] for _ in texts]
    work = [(k, stretch) for k, text in enumerate(texts) for stretch in chains_of(text)]
    done: dict[int, dict[tuple[int, int], list[Span]]] = {}
    while work:
        grown: dict[int, list[tuple[int, int]]] = {}
        for k, stretch, spans, is_open in _decoded(texts, work, model):
            if is_open:
                more = stretch[1] - stretch[0]
                grown.setdefault(k, []).append((stretch[0] - more, stretch[1] + more))
            else:
                done.setdefault(k, {})[stretch] = spans
        work = []
        for k, stretches in grown.items():
            # A chain that a grown one reaches becomes part of it.
            all_of = _merged(texts[k], sorted([*stretches, *done.get(k, {})]))
            kept = done.get(k, {})
            work += [(k, stretch) for stretch in all_of if stretch not in kept]
            done[k] = {stretch: kept[stretch] for stretch in all_of if stretch in kept}
    for k, chains in done.items():
        found[k] = [
            span
            for spans in chains.values()
            for span in spans
            if _CHECKS[span[0]](texts[k][span[1] : span[2]])
        ]
    return found


def added_spans(base: list[Span], model: list[Span]) -> list[Span]:
    """Model spans that touch no span of the patterns. Both are in order of start."""
    kept, k, furthest = [], 0, -1
    for span in sorted(model, key=lambda s: (s[1], s[0])):
        while k < len(base) and base[k][1] < span[2]:
            furthest = max(furthest, base[k][2])
            k += 1
        if furthest <= span[1]:
            kept.append(span)
    return kept


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_pii(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    examples: Iterable[str] = EXAMPLES,
) -> DataFrame:
    """Personal data in each text: ``_id``, ``base`` and ``added`` spans.

    ``base`` holds what the patterns find; ``added`` what a conditional random field
    over word shapes finds besides, where it touches no base span. The model is trained
    from ``examples``, a small table in the code, and decoded by Viterbi in batches.
    Its chains are the tokens around digits, @, "at" and "dot", and grow until no span is
    near their ends; what holds none of these can be no personal data. A very long chain
    is decoded in pieces that end where no span is, so memory stays at some times the
    text's own size. Spans are in code points, end exclusive, in order of start, then
    kind. Null or empty texts have none; an empty table gives an empty table.
    Rows are independent, so repeated rows give repeated results.
    """
    model = train(examples)
    kind = docs.schema[id_col].dataType.simpleString()

    def column(spans: list[list[Span]]) -> pa.Array:
        flat = [s for own in spans for s in own]
        ends = np.cumsum([0, *map(len, spans)]).astype(np.int32)
        rows = pa.StructArray.from_arrays(
            [
                pa.array([KINDS[s[0]] for s in flat], pa.string()),
                pa.array([s[1] for s in flat], pa.int32()),
                pa.array([s[2] for s in flat], pa.int32()),
            ],
            names=["kind", "start", "end"],
        )
        return pa.ListArray.from_arrays(pa.array(ends), rows)

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [x.as_py() or "" for x in part.column(1)]
                base = [base_spans(t) for t in texts]
                added = list(map(added_spans, base, model_spans(texts, model)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), column(base), column(added)], names=["_id", "base", "added"]
                )

    return docs.select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")
    ).mapInArrow(searched, f"_id {kind}, base {_SPANS}, added {_SPANS}")
