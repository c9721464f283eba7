"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The field labels every word of a sentence with a kind of personal data or none. Its scores are sums
of learned weights for the shape of a word and of its neighbours (runs of upper-case, lower-case,
digits and single signs, with the count of digits), for a few cue words, and for each pair of
neighbouring labels. Weights maximize the likelihood of a small labelled table of sentences that
``training_sentences`` writes from a seed, by forward-backward sums. Decoding is Viterbi over all
sentences of a batch at once, word position by word position, in numpy.

Spans of the patterns always stay; spans of the field are added where they touch none of them.
Texts are read where they lie: nothing is shuffled.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riskspark.llm.common import Rolling, as_rows, mix, ready, text_chunks, word_bounds, word_hashes

#: Kinds of the fixed patterns, in the order that breaks ties.
BASE_KINDS = ("email", "ip", "card", "phone")
#: All kinds; the field has one label for each and one for other words.
KINDS = (*BASE_KINDS, "secret", "id")
#: Words after which a stretch without a full stop may be cut, where ``CALM`` words on either side are letters alone.
SENTENCE = 128
CALM = 3
#: Text bytes labelled in one go: each word has a row of numbers for every feature and label meanwhile.
CHUNK = 1 << 20
#: Occurrences in the labelled table that make a shape, a coarse shape or a form known to the field.
KNOWN = (2, 2, 12)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Bytes of letters; those of non-ASCII characters count as such.
_LETTERS = np.arange(256) >= 128
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # an address begins where the run of local characters before its sign does, but not before the
    # end of the last one; stepping from sign to sign keeps this linear
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns, leftmost and not overlapping within a kind; sorted as they are printed."""
    found = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in match.group().split(".")):
            found.append((*match.span(), "ip"))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*match.span(), "card"))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum(c.isascii() and c.isdigit() for c in match.group()) <= 15:
                found.append((*match.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], BASE_KINDS.index(s[2])))


# --- features -----------------------------------------------------------------------------------

_CLASS = np.arange(256, dtype=np.uint64) + np.uint64(16)
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128:] = 1, 2, 3, 3
_CLASS[97:103] = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Upper ends of the classes that digit counts and lengths fall into.
_DIGIT_STEPS = np.array([0, 1, 2, 3, 4, 5, 8, 9, 11, 15, 16, 19])
_LENGTH_STEPS = np.array([1, 2, 3, 6, 12, 20, 31, 64])
#: Coarse shape of words of letters alone; they are never part of personal data.
LETTERS = np.uint64(1)
_STRIP = b"\"'`,;:!?()[]{}<>|*#$%&."


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each word the hashes of its shape, of its coarse shape and of its form.

    Shape: the runs of character classes. Coarse shape: their number. Both go with a class for the
    number of digits, one for the length, and whether 12 to 19 digits pass the card check. Form:
    lower case, without outer signs. A word of letters alone has the coarse shape ``LETTERS``.
    """
    classes = _CLASS[data]
    # one entry per run of a class within a word
    turn = np.ones(len(data), bool)
    turn[1:] = classes[1:] != classes[:-1]
    turn[starts] = True
    before = np.append(0, np.cumsum(turn))
    shape = Rolling(classes[turn]).spans(before[starts], before[ends])
    digits = np.append(0, np.cumsum(classes == 1))
    count = digits[ends] - digits[starts]
    steps = (np.searchsorted(_DIGIT_STEPS, count) * 16 + np.searchsorted(_LENGTH_STEPS, ends - starts)).astype(np.uint64)
    for i in np.flatnonzero((count >= 12) & (count <= 19)).tolist():
        word = data[starts[i] : ends[i]]
        steps[i] += np.uint64(512 * luhn(word[classes[starts[i] : ends[i]] == 1].tobytes().decode()))
    coarse = np.minimum(before[ends] - before[starts], 12).astype(np.uint64)
    lowered = _LOWER[data]
    signs = np.zeros(256, bool)
    signs[list(_STRIP)] = True
    inner = np.append(0, np.cumsum(~signs[lowered]))
    first = np.minimum(np.searchsorted(inner, inner[starts], "right") - 1, ends)
    last = np.maximum(np.searchsorted(inner, inner[ends], "left"), first)
    form = word_hashes(lowered, first, last)
    letters = np.append(0, np.cumsum((classes == 2) | (classes == 3)))
    coarse = mix(coarse * np.uint64(1024) + steps)
    coarse[letters[last] - letters[first] == last - first] = LETTERS
    return np.stack([mix(shape + mix(steps)), coarse, form])


def _calm_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words before which a cut changes no label of interest.

    Words of letters alone are never marked, and no feature reaches further than two words, so a cut
    amid six such words parts no span and hides no cue.
    """
    others = np.append(0, np.cumsum(~_LETTERS[data]))
    letters = np.append(0, np.cumsum(others[ends] == others[starts]))
    at = np.arange(CALM, len(starts) - CALM + 1)
    return at[letters[at + CALM] - letters[at - CALM] == 2 * CALM]


def sentence_starts(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Indexes of words that begin a sentence: after a full stop or a line end.

    A long stretch without them is cut too, at calm places only; without one it stays whole.
    """
    begins = np.zeros(len(starts) + 1, bool)
    begins[first] = True
    if len(starts):
        stop = np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8))
        breaks = np.append(0, np.cumsum(data == 10))
        newline = breaks[starts[1:]] > breaks[ends[:-1]]
        begins[1:-1] |= stop[:-1] | newline
    begins = np.flatnonzero(begins[:-1])
    sizes = np.diff(np.append(begins, len(starts)))
    cuts = []
    if (sizes > SENTENCE).any():
        calm = _calm_places(data, starts, ends)
        for low, size in zip(begins[sizes > SENTENCE].tolist(), sizes[sizes > SENTENCE].tolist()):
            end = low + size
            while True:
                at = int(np.searchsorted(calm, low + SENTENCE))
                if at == len(calm) or calm[at] >= end:
                    break
                low = int(calm[at])
                cuts.append(low)
    return np.sort(np.concatenate([begins, np.array(cuts, np.int64)])) if cuts else begins


class ChainField:
    """Weights of the chain: a table of scores per label for each view, and label pairs."""

    #: (place relative to the word, which feature): its own shape, coarse shape and form, and its neighbours'
    VIEWS = ((0, 0), (0, 1), (0, 2), (-1, 1), (1, 1), (-2, 2), (-1, 2), (1, 2), (2, 2))

    def __init__(self, labels: int, known: list[np.ndarray]):
        #: sorted hashes that each feature tells apart; all others are one
        self.known = known
        self.tables = [np.zeros((len(known[which]) + 2, labels)) for _, which in self.VIEWS]
        self.pairs = np.zeros((labels, labels))
        self.first = np.zeros(labels)

    def buckets(self, features: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Row per view and word: 0 for what is not known, 1 beyond the ends of a sentence."""
        count = features.shape[1]
        sentence = np.zeros(count, np.int64)
        sentence[begins] = 1
        sentence = np.cumsum(sentence)
        rows = []
        for known, values in zip(self.known, features):
            at = np.minimum(np.searchsorted(known, values), max(0, len(known) - 1))
            rows.append(np.where(known[at] == values, at + 2, 0) if len(known) else np.zeros(count, np.int64))
        out = np.ones((len(self.VIEWS), count), np.int64)
        for view, (shift, which) in enumerate(self.VIEWS):
            if shift == 0:
                out[view] = rows[which]
            elif abs(shift) < count:
                here = slice(-shift, None) if shift < 0 else slice(None, -shift)
                there = slice(None, shift) if shift < 0 else slice(shift, None)
                out[view][here] = np.where(sentence[here] == sentence[there], rows[which][there], 1)
        return out

    def scores(self, buckets: np.ndarray) -> np.ndarray:
        total = self.tables[0][buckets[0]]
        for table, rows in zip(self.tables[1:], buckets[1:]):
            total = total + table[rows]
        return total

    @staticmethod
    def _steps(begins: np.ndarray, count: int) -> list[np.ndarray]:
        """Word indexes by position in their sentence; sentences in order of falling length."""
        sizes = np.diff(np.append(begins, count))
        order = np.argsort(-sizes, kind="stable")
        begins, sizes = begins[order], sizes[order]
        longer = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
        return [begins[:n] + step for step, n in enumerate(longer.tolist())]

    def decode(self, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Viterbi labels of all words, all sentences side by side."""
        labels = np.zeros(len(scores), np.int64)
        steps = self._steps(begins, len(scores))
        if not steps:
            return labels
        best, back = scores[steps[0]] + self.first, [None]
        final = [best]
        for step in steps[1:]:
            paths = best[: len(step), :, None] + self.pairs
            back.append(paths.argmax(axis=1))
            best = paths.max(axis=1) + scores[step]
            final.append(best)
        chosen = np.zeros(0, np.int64)
        for i in range(len(steps) - 1, -1, -1):
            ended = final[i][len(chosen) :].argmax(axis=1)
            if i + 1 < len(steps) and len(chosen):
                chosen = back[i + 1][np.arange(len(chosen)), chosen]
            chosen = np.concatenate([chosen, ended])
            labels[steps[i]] = chosen
        return labels

    def fit(self, buckets: np.ndarray, begins: np.ndarray, labels: np.ndarray, rounds: int = 80, rate: float = 0.5):
        """Gradient ascent with adaptive steps on the log likelihood, forward-backward for its sums."""
        steps = self._steps(begins, len(labels))
        size = self.pairs.shape[0]
        gold = np.eye(size)[labels]
        same = np.ones(len(labels), bool)
        same[begins] = False
        at = np.flatnonzero(same)
        gold_pairs = np.zeros_like(self.pairs)
        np.add.at(gold_pairs, (labels[at - 1], labels[at]), 1)
        sorts = [np.argsort(rows, kind="stable") for rows in buckets]
        cuts = [np.flatnonzero(np.append(True, np.diff(rows[order]) > 0)) for rows, order in zip(buckets, sorts)]
        weights = [*self.tables, self.pairs, self.first]
        history = [np.full_like(x, 1e-6) for x in weights]
        for _ in range(rounds):
            scores = self.scores(buckets)
            alphas = [scores[steps[0]] + self.first]
            for step in steps[1:]:
                alphas.append(_log_sum(alphas[-1][: len(step), :, None] + self.pairs, 1) + scores[step])
            expected = np.zeros_like(scores)
            pair_sums = np.zeros_like(self.pairs)
            beta = np.zeros((0, size))
            norm = np.zeros(0)
            for i in range(len(steps) - 1, -1, -1):
                if i + 1 < len(steps):
                    ahead = self.pairs + (scores[steps[i + 1]] + beta)[:, None, :]
                    joint = alphas[i][: len(beta), :, None] + ahead - norm[:, None, None]
                    pair_sums += np.exp(joint).sum(axis=0)
                    beta = _log_sum(ahead, 2)
                ended = alphas[i][len(beta) :]
                norm = np.concatenate([norm, _log_sum(ended, 1)])
                beta = np.concatenate([beta, np.zeros((len(ended), size))])
                expected[steps[i]] = np.exp(alphas[i] + beta - norm[:, None])
            slope = gold - expected
            slopes = []
            for table, rows, order, cut in zip(self.tables, buckets, sorts, cuts):
                gradient = -0.05 * table
                gradient[rows[order[cut]]] += np.add.reduceat(slope[order], cut, axis=0)
                slopes.append(gradient)
            slopes += [gold_pairs - pair_sums - 0.05 * self.pairs, slope[begins].sum(axis=0) - 0.05 * self.first]
            for weight, gradient, seen in zip(weights, slopes, history):
                seen += gradient**2
                weight += rate * gradient / np.sqrt(seen)
        return self


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


# --- the labelled table -------------------------------------------------------------------------


def training_sentences(count: int = 3000, seed: int = 7) -> list[list[tuple[str, str]]]:
    """Labelled sentences: words of made-up text with a value of some kind, or something like one."""
    rng = random.Random(seed)
    syllables = "an er on the in re ti en la que de ou ion ch sch ung be st le ar os co mi da ver é ü ñ ß è".split()
    common = "the of and to in is that was for with le la les des et que der die und das ist von el los por para con".split()

    def word() -> str:
        made = rng.choice(common) if rng.random() < 0.35 else "".join(rng.choices(syllables, k=rng.randint(1, 5)))
        made = made.capitalize() if rng.random() < 0.1 else made.upper() if rng.random() < 0.03 else made
        return made + rng.choice(["", "", "", "", ",", ".", "***", "%%%", "!!", "###", "$$$", "&&&"] if rng.random() < 0.2 else [""])

    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    name = lambda: "".join(rng.choices(syllables[:24], k=rng.randint(1, 3)))
    host = lambda: rng.choice(["mail", "web", "post", "corp"]) + str(rng.randint(0, 9)) * rng.randint(0, 1) + rng.choice([".example.com", ".test.org", ".co.uk", ".de"])
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    mixed = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n))

    def card(valid: bool) -> str:
        while True:
            value = digits(16)
            if luhn(value) == valid:
                return value

    grouped = lambda s: " ".join(s[i : i + 4] for i in range(0, 16, 4))
    key = lambda: rng.choice(["token", "api_key", "secret", "password", "apikey", "auth_token", "access_key"])
    quote = lambda s: rng.choice([f'"{s}"', f"'{s}'", s])
    # (words before, value, kind, words after)
    makers = [
        (3, lambda: ("", f"{name()}.{digits(2)}@{host()}", "email")),
        (1, lambda: (rng.choice(["mail", "email", "contact:"]), f"{name()}_{name()}@{host()}", "email")),
        (2, lambda: ("", f"{name()}{rng.choice(['(at)', '[at]', '{at}'])}{host()}", "email")),
        (3, lambda: ("", ".".join(str(rng.randint(0, 255)) for _ in range(4)), "ip")),
        (3, lambda: ("", f"+{rng.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}", "phone")),
        (1, lambda: ("", f"+{rng.randint(1, 99)} {digits(3)} {digits(7)}", "phone")),
        (2, lambda: (rng.choice(["", "call", "tel:", "phone"]), f"({digits(3)}) {digits(3)}-{digits(4)}", "phone")),
        (1, lambda: (rng.choice(["call", "tel:", "phone", "tel."]), f"{digits(3)}-{digits(3)}-{digits(4)}", "phone")),
        (3, lambda: ("", card(True), "card")),
        (1, lambda: (rng.choice(["card", "visa", "karte"]), grouped(card(True)), "card")),
        (3, lambda: (f"{key()} {rng.choice(['=', ':'])}", quote(hexes(rng.choice([32, 40, 64]))), "secret")),
        (1, lambda: ("", hexes(40), "secret")),
        (2, lambda: (f"{key()}{rng.choice(['', ':'])} {rng.choice(['=', ':', 'is'])}", quote(mixed(rng.randint(16, 44))), "secret")),
        (1, lambda: ("", rng.choice(["AKIA", "ghp_", "sk-"]) + mixed(rng.randint(16, 36)), "secret")),
        (2, lambda: (rng.choice(["ssn", "ssn:", "social security", ""]), f"{digits(3)}-{digits(2)}-{digits(4)}", "id")),
        (1, lambda: (rng.choice(["iban", "iban:"]), rng.choice(["DE", "FR", "ES", "GB"]) + digits(20), "id")),
        # what is not personal data
        (6, lambda: ("", "", "")),
        (3, lambda: ("", digits(rng.randint(1, 8)), "")),
        (2, lambda: (rng.choice(["version", "v", ""]), f"{digits(1)}.{digits(1)}{rng.choice(['', '.', '.' + digits(1)])}", "")),
        (2, lambda: ("", f"20{digits(2)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", "")),
        (1, lambda: ("", f"{rng.randint(1, 23)}:{rng.randint(0, 59):02d}", "")),
        (1, lambda: (rng.choice(["$", "€", ""]), f"{digits(3)},{digits(3)}.{digits(2)}", "")),
        (1, lambda: (rng.choice(["isbn", "order", "nr.", "id"]), digits(rng.choice([10, 13])), "")),
        (3, lambda: ("", card(False), "")),
        (1, lambda: ("at the", rng.choice(["door", "end", "dot", "at"]), "")),
        (1, lambda: (f"the {key()}", word(), "")),
        (1, lambda: ("", f"http://www.{name()}.example.com/{name()}/{digits(3)}", "")),
        (1, lambda: ("", f"{'.'.join([digits(1)] * 3)}", "")),
        (1, lambda: ("licensed under cc by-nc", "4.0.", "")),
        (1, lambda: ("apache license, version", "2.0.", "")),
        (1, lambda: ("", "|", "")),
    ]
    weights = [w for w, _ in makers]
    table = []
    for _ in range(count):
        sentence = [(word(), "") for _ in range(rng.randint(0, 7))]
        for _ in range(rng.choice([1, 1, 1, 2])):
            before, value, kind = rng.choices(makers, weights)[0][1]()
            sentence += [(w, "") for w in before.split()]
            if kind and rng.random() < 0.15:
                value += rng.choice([",", ".", ";", "%%%", "***", "!!"])
            sentence += [(w, kind) for w in value.split()]
            sentence += [(word(), "") for _ in range(rng.randint(0, 6))]
        table.append(sentence or [(word(), "")])
    return table


def _flat(table: list[list[tuple[str, str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, sentence starts and label numbers of a labelled table."""
    words = [w for sentence in table for w, _ in sentence]
    encoded = [w.encode() for w in words]
    data = np.frombuffer(b" ".join(encoded), np.uint8)
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    starts = np.append(0, np.cumsum(sizes + 1)[:-1])
    begins = np.append(0, np.cumsum([len(s) for s in table])[:-1])
    labels = np.array([KINDS.index(k) + 1 if k else 0 for s in table for _, k in s])
    return word_features(data, starts, starts + sizes), begins, labels


@lru_cache(maxsize=1)
def trained_field() -> ChainField:
    """The field learned from the built-in labelled table; a second or two on the driver."""
    features, begins, labels = _flat(training_sentences())
    known = []
    for values, least in zip(features, KNOWN):
        hashes, counts = np.unique(values, return_counts=True)
        known.append(hashes[counts >= least])
    field = ChainField(len(KINDS) + 1, known)
    return field.fit(field.buckets(features, begins), begins, labels)


# --- spans --------------------------------------------------------------------------------------


def field_spans(field: ChainField, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, str]]]:
    """For each text the byte spans that the field marks, without outer signs."""
    starts, ends, first = word_bounds(data, offsets)
    found: list[list[tuple[int, int, str]]] = [[] for _ in range(len(offsets) - 1)]
    if not len(starts):
        return found
    begins = sentence_starts(data, ends, starts, first)
    features = word_features(data, starts, ends)
    scores = field.scores(field.buckets(features, begins))
    scores[features[1] == LETTERS, 1:] = -1e6
    labels = field.decode(scores, begins)
    opens = labels > 0
    fresh = np.ones(len(labels), bool)
    fresh[1:] = labels[1:] != labels[:-1]
    fresh[begins] = True
    heads = np.flatnonzero(opens & fresh)
    tails = np.flatnonzero(opens & np.append(fresh[1:], True))
    owner = np.searchsorted(first, heads, "right") - 1
    for head, tail, row in zip(heads.tolist(), tails.tolist(), owner.tolist()):
        a, b = int(starts[head]), int(ends[tail])
        raw = data[a:b].tobytes()
        left = len(raw) - len(raw.lstrip(_STRIP.replace(b"(", b"")))
        right = len(raw.rstrip(_STRIP.replace(b")", b"") if b"(" in raw else _STRIP))
        if left < right:
            found[row].append((a + left - int(offsets[row]), a + right - int(offsets[row]), KINDS[labels[head] - 1]))
    return found


def with_spans(docs: DataFrame, field: ChainField | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: doc_id) with ``base`` and ``spans``: arrays of start, end, kind.

    Places are code points, ends exclusive. ``base`` are the spans of the fixed patterns; ``spans``
    adds those of the field that touch none of them. Null and empty texts have none. One row per
    input row, in any case; no rows give no rows.
    """
    shared = ready(docs.sparkSession).sparkContext.broadcast(field or trained_field())
    keep = ["doc_id"] if keep is None else keep
    source = docs.select(*keep, F.col("text").alias("__text"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    spans_type = T._parse_datatype_string("array<struct<start: long, end: long, kind: string>>")
    fields = [T.StructField("base", spans_type), T.StructField("spans", spans_type)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {kind: i for i, kind in enumerate(KINDS)}
        as_structs = lambda spans: [{"start": a, "end": b, "kind": k} for a, b, k in spans]
        for rows, data, offsets in text_chunks(batches, "__text", CHUNK):
            body, base, merged = data.tobytes(), [], []
            points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
            learned = field_spans(shared.value, data, offsets)
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                fixed = base_spans(body[a:b].decode())
                more = [(int(points[a + s] - points[a]), int(points[a + e] - points[a]), k) for s, e, k in learned[i]]
                if fixed and more:
                    begin = np.array([s for s, _, _ in fixed])
                    reach = np.maximum.accumulate([e for _, e, _ in fixed])
                    # the base spans that begin before the end of one must all end before its start
                    before = [int(np.searchsorted(begin, e)) for _, e, _ in more]
                    more = [m for m, n in zip(more, before) if not n or reach[n - 1] <= m[0]]
                base.append(as_structs(fixed))
                merged.append(as_structs(sorted([*fixed, *more], key=lambda s: (s[0], order[s[2]]))))
            columns = [rows.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(base, span), pa.array(merged, span)], names=[*keep, "base", "spans"]
            )

    return source.mapInArrow(run, T.StructType([*docs.select(*keep).schema.fields, *fields]))


def redact(docs: DataFrame, field: ChainField | None = None) -> DataFrame:
    """The rows of ``docs`` with every span in ``text`` replaced by its kind in angle brackets.

    ``n_chars``, where there is one, is set to the new length. Null texts stay null.
    """
    marked = with_spans(as_rows(docs, "text"), field, ["row", "text"])
    step = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("done"))

    def replace(state, span):
        # a span inside one that is done already adds nothing
        gap = F.substring("text", (state["done"] + 1).cast("int"), F.greatest(span["start"] - state["done"], F.lit(0)).cast("int"))
        label = F.when(span["start"] >= state["done"], F.concat(gap, F.lit("<"), F.upper(span["kind"]), F.lit(">"))).otherwise("")
        return F.struct(F.concat(state["out"], label).alias("out"), F.greatest(state["done"], span["end"]).alias("done"))

    def finish(state):
        rest = F.substring("text", (state["done"] + 1).cast("int"), F.length("text"))
        return F.concat(state["out"], rest)

    text = F.when(F.size("spans") > 0, F.aggregate("spans", step, replace, finish)).otherwise(F.col("text"))
    done = marked.select("row", text.alias("redacted"))
    columns = {name: F.col("row")[name].alias(name) for name in docs.columns}
    columns["text"] = F.col("redacted").alias("text")
    if "n_chars" in columns:
        columns["n_chars"] = F.length("redacted").cast(dict(docs.dtypes)["n_chars"]).alias("n_chars")
    return done.select(*columns.values())
