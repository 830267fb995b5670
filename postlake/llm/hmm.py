"""Language-model scores from a hidden Markov model, beside a unigram base score.

Tokens are words (runs without ASCII white space, A-Z in lower case), then one end.
The base score needs every token's count in the training rows. Tokens that make up at
least ``HEAVY`` of all (so ``1 / HEAVY`` at most) are looked up from a broadcast, in
the task that reads the text; the rest meet the count table in a shuffled join.

The model has ``STATES`` latent states. In the rounds its symbols are the tokens that
make up at least ``SYMBOL`` of all, the end, and one for any other token. Baum-Welch
starts on about ``START_TEXTS`` texts of at most ``START_TOKENS`` tokens (fixed bounds;
by hash), then makes rounds over all training rows, ``ROUNDS`` and one more at least,
until the next would gain less than ``SETTLED`` of log-likelihood per token: every task
sums expected counts over its texts, and the sums are added up by symbol.

Then every other token of the training rows, down to those seen once, gets emissions of
its own: a pass over all training rows sums its expected counts ``c`` by state, in a
table keyed by token. State k emits it with ``P(other | k) * base(token) / base(other)``
times its tilt ``(c[k] * C / C[k] + 1) / (n + 1)``, where the capitals are sums over
the other tokens; an unseen token has tilt 1. That is the base score's add-one rule
within each state, so these are distributions over texts, comparable with the base. A
scaled forward recursion gives each text's exact likelihood.

Texts are stored once as symbol numbers, two bytes each, and four more for each other
token; tilts meet them as the rare tokens' counts do. For training, a text of more
than ``PIECE`` tokens counts as several; scoring takes any length in constant memory
per text beyond its symbols.

Defined results: a null or empty text is the end alone; rows with a null id are not
held out and train; repeated rows are each counted and scored; without training rows
every base probability is 1 and the model knows only "other" and the end.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice
from math import log, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import FOLD, batch, map_batches, split_of, stored, utf8

STATES = 6
HEAVY = 5e-7
SYMBOL = 1 / 60_000
START_TEXTS, START_TOKENS, START_ROUNDS = 800, 1 << 13, 15
ROUNDS = 2
SETTLED = 1e-3
PIECE = 1 << 16
# Tokens a task runs through side by side; it holds some 200 bytes for each.
TOGETHER = 1 << 19
# Weight, in tokens, of the base distribution in every state's emissions.
PRIOR = 50.0
DISTINCT = 1 << 18
COUNTS = "token long, n long"


def tokens_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def _digest(token: bytes) -> int:
    value = xxhash.xxh64_intdigest(token)
    return value - (1 << 64) if value >> 63 else value


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) over all rows, tokens by 64-bit hash, without the ends."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            out = batch(COUNTS, list(map(_digest, seen)), list(seen.values()))
            seen.clear()
            return out

        for part in batches:
            for text in utf8(part["text"]):
                seen.update(tokens_of(text))
                if len(seen) >= DISTINCT:
                    yield flushed()
        yield flushed()

    return map_batches(texts, step, COUNTS).groupBy("token").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Counts of heavy tokens, sorted by hash, and the totals of the training rows.

    Symbols are numbered over the heavy tokens that are frequent enough, in order of
    hash; ``other`` and ``end`` follow.
    """

    def __init__(self, token: np.ndarray, n: np.ndarray, total: int, distinct: int, ends: int):
        order = np.argsort(token)
        self.token, self.n = token[order], n[order]
        self.total, self.distinct, self.ends = total, distinct, ends
        frequent = self.n >= SYMBOL * total
        self.symbols = int(frequent.sum())
        self.other, self.end = self.symbols, self.symbols + 1
        self.symbol = np.where(frequent, np.cumsum(frequent) - 1, self.other).astype(np.uint16)
        self.scale = total + distinct + 1

    def base(self) -> np.ndarray:
        """Base probability of each symbol; that of ``other`` is what the rest leaves."""
        known = (self.n[self.symbol != self.other] + 1) / self.scale
        end = (self.ends + 1) / self.scale if self.ends else 0.5
        return np.concatenate([known, [max(1 - known.sum() - end, 1e-12)], [end]])

    def plain(self) -> tuple:
        return self.token, self.n, self.total, self.distinct, self.ends


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + ends, distinct + (ends > 0)
    # At most 1 / HEAVY rows can hold such a share each.
    heavy = counts.filter(F.col("n") >= F.lit(HEAVY * total)).toPandas()
    return Vocabulary(
        heavy["token"].to_numpy(np.int64), heavy["n"].to_numpy(np.int64), total, distinct, ends
    )


ENCODED = (
    "doc_id long, held_out boolean, n_tokens long, n_heavy long, log_heavy double, "
    "n_other long, log_symbols double, symbols binary, others binary, rare array<long>, "
    "rare_n array<int>"
)


class _Numbers(dict):
    """Numbers of tokens in the order in which they are first met."""

    def __missing__(self, token: bytes) -> int:
        self[token] = at = len(self)
        return at


class _Codes:
    """Code of each token: its place among the heavy ones, or beyond them."""

    def __init__(self, heavy: np.ndarray):
        self.heavy, self.rare = heavy, np.zeros(0, np.int64)
        self.number, self.place = _Numbers(), np.zeros(0, np.int32)

    def of(self, words: list[bytes]) -> np.ndarray:
        met = len(self.number)
        number = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        new = list(islice(self.number, met, None))
        value = np.fromiter(map(_digest, new), np.int64, len(new))
        at = np.searchsorted(self.heavy, value).astype(np.int32)
        rare = np.ones(len(new), bool)
        if len(self.heavy):
            rare = self.heavy[np.minimum(at, len(self.heavy) - 1)] != value
        at[rare] = len(self.heavy) + len(self.rare) + np.arange(int(rare.sum()))
        self.rare = np.concatenate([self.rare, value[rare]])
        self.place = np.concatenate([self.place, at])
        return self.place[number]


def encoded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Texts as symbols, with what their heavy tokens add to the base score and the
    hashes and numbers of the rare tokens. ``others`` names the tokens behind the symbol
    ``other``: places among the heavy ones, then among the text's rare ones. Logarithms
    are of ``count + 1``."""
    held = docs.sparkSession.sparkContext.broadcast(known.plain())

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(*held.value)
        heavy = len(vocab.token)
        # The last place of each stands for any rare token.
        logs = np.append(np.log10(vocab.n + 1.0), 0.0)
        symbols = np.append(vocab.symbol, np.uint16(vocab.other)).astype(np.uint16)
        end_log = log10(vocab.ends + 1)
        codes = _Codes(vocab.token)
        for part in batches:
            if len(codes.rare) > DISTINCT:
                codes = _Codes(vocab.token)
            split = [tokens_of(text) for text in utf8(part["text"])]
            n = len(split)
            sizes = np.fromiter(map(len, split), np.int64, n)
            total = int(sizes.sum())
            code = codes.of(list(chain.from_iterable(split)))
            del split
            row = np.repeat(np.arange(n, dtype=np.int32), sizes)
            known = np.minimum(code, heavy)
            symbol, log = symbols[known], logs[known]
            light, other = np.flatnonzero(code >= heavy), np.flatnonzero(symbol == vocab.other)
            log_heavy = np.bincount(row, log, n)
            # The distinct rare tokens of each row, and for each token its place there.
            value, at, times = np.unique(
                (row[light].astype(np.int64) << 40) + code[light], return_inverse=True, return_counts=True
            )
            cuts = np.searchsorted(value, np.arange(n + 1) << 40)
            code[light] = heavy + at - cuts[row[light]]
            ends = np.cumsum(sizes + 1)
            whole = np.full(total + n, vocab.end, "<u2")
            whole[np.arange(total) + row] = symbol
            behind = code[other].astype("<i4").tobytes()
            n_other = np.bincount(row[other], minlength=n)
            bounds = np.concatenate([[0], np.cumsum(n_other)])
            offsets = pa.array(cuts, pa.int32())
            yield batch(
                ENCODED,
                part["doc_id"],
                part["held_out"],
                pa.array(sizes + 1),
                pa.array(sizes - np.bincount(row[light], minlength=n) + (vocab.ends > 0)),
                pa.array(log_heavy + end_log),
                pa.array(n_other),
                pa.array(log_heavy - np.bincount(row[other], log[other], n) + end_log),
                [whole[e - k : e].tobytes() for e, k in zip(ends.tolist(), (sizes + 1).tolist(), strict=True)],
                [behind[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)],
                pa.ListArray.from_arrays(offsets, pa.array(codes.rare[(value & ((1 << 40) - 1)) - heavy])),
                pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
            )

    return map_batches(docs, step, ENCODED)


class Model:
    """Start, transition and emission probabilities; emissions are rows by symbol."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, base: np.ndarray, states: int) -> Model:
        """The base distribution, disturbed at random so that states can part."""
        rng = np.random.default_rng(7)
        emit = base[:, None] * rng.gamma(1.0, size=(len(base), states)) + 1e-3 * base[:, None]
        move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, base: np.ndarray) -> Model:
        start, move = start + 1.0, move + 1.0
        emit = emit + PRIOR * base[:, None]
        return cls(
            start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
        )

    def plain(self) -> tuple:
        return self.start, self.move, self.emit

    def single(self) -> tuple:
        """In single precision, which counts are summed up with; scores are not."""
        return tuple(x.astype(np.float32) for x in self.plain())


def side_by_side(texts: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of like length together, longest first: their numbers, lengths and symbols
    one after another, about ``most`` symbols at a time."""
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        n = max(1, int(np.searchsorted(np.cumsum(lengths[order[at:]]), most, side="right")))
        chosen = order[at : at + n]
        yield chosen, lengths[chosen], np.concatenate([texts[i] for i in chosen])
        at += n


class Steps:
    """Texts of falling lengths step by step: at step t stand the t-th symbols of all
    texts longer than t, in rows ``first[t]`` to ``first[t + 1]``."""

    def __init__(self, lengths: np.ndarray):
        # active[t]: texts longer than t.
        self.active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")
        self.first = np.concatenate([[0], np.cumsum(self.active)])
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])

    def places(self, low: int, high: int) -> np.ndarray:
        """For the rows of steps ``low`` to ``high``, places of their symbols."""
        n = self.active[low:high]
        row = np.arange(self.first[high] - self.first[low])
        step = np.repeat(np.arange(low, high), n)
        return self.starts[row - (self.first[step] - self.first[low])] + step


def forward(
    model: Model,
    lengths: np.ndarray,
    symbols: np.ndarray,
    tilts: np.ndarray | None = None,
    places: np.ndarray | None = None,
) -> np.ndarray:
    """Natural log-likelihood of each text, by the scaled recursion; lengths fall. A
    symbol's emissions are multiplied by the row of ``tilts`` at its place, if given."""
    steps = Steps(lengths)
    total = np.zeros(len(lengths))
    alpha, low = None, 0
    while low < len(steps.active):
        # As many steps at once as keep few emissions; one at least.
        high = int(np.searchsorted(steps.first, steps.first[low] + TOGETHER, side="right")) - 1
        high = min(max(high, low + 1), len(steps.active))
        where = steps.places(low, high)
        seen = model.emit[symbols[where]]
        if tilts is not None:
            seen *= tilts[places[where]]
        scale = np.empty(len(seen))
        cuts = (steps.first[low : high + 1] - steps.first[low]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            alpha = seen[a:b] * (model.start if alpha is None else alpha[: b - a] @ model.move)
            sums = alpha.sum(axis=1)
            scale[a:b] = sums
            alpha /= sums[:, None]
        text = np.arange(len(seen)) - np.repeat(cuts[:-1], np.diff(cuts))
        total += np.bincount(text, np.log(scale), len(total))
        low = high
    return total


def expected(
    model: Model,
    lengths: np.ndarray,
    symbols: np.ndarray,
    counts: list[np.ndarray],
    labels: np.ndarray | None = None,
) -> float:
    """Add the texts' expected start, transition and emission counts, emissions by label
    instead of symbol where ``labels`` are given; the log-likelihood. Lengths fall."""
    steps = Steps(lengths)
    n, first = steps.active.tolist(), steps.first.tolist()
    where = steps.places(0, len(n))
    symbol = symbols[where]
    label = symbol if labels is None else labels[where]
    seen = model.emit[symbol]
    alpha, scale = np.empty_like(seen), np.empty(len(seen), seen.dtype)
    for t, k in enumerate(n):
        a, b = first[t], first[t] + k
        before = model.start if t == 0 else alpha[first[t - 1] : first[t - 1] + k] @ model.move
        value = np.multiply(seen[a:b], before, out=alpha[a:b])
        value.sum(axis=1, out=scale[a:b])
        value /= scale[a:b, None]
    seen /= scale[:, None]
    # From the last step back, seen becomes emission times beta, and alpha the posterior.
    moves = np.zeros(model.move.shape)
    for t in range(len(n) - 2, -1, -1):
        a, k = first[t], n[t + 1]
        ahead = seen[first[t + 1] : first[t + 1] + k]
        beta = ahead @ model.move.T
        moves += alpha[a : a + k].T @ ahead
        alpha[a : a + k] *= beta
        seen[a : a + k] *= beta
    counts[0] += alpha[: n[0]].sum(axis=0)
    counts[1] += moves * model.move
    for k in range(len(model.start)):
        counts[2][:, k] += np.bincount(label, alpha[:, k], len(counts[2]))
    return float(np.log(scale).sum(dtype=float))


def zeros(model: Model) -> list[np.ndarray]:
    return [np.zeros(x.shape) for x in model.plain()]


def pieces(column: pa.Array) -> list[np.ndarray]:
    texts = [np.frombuffer(x, "<u2").astype(np.int64) for x in column.to_pylist()]
    return [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]


def baum_welch(texts: DataFrame, model: Model, base: np.ndarray) -> Model:
    """One round over all texts."""
    return _round(texts, model, base)[0]


def _round(texts: DataFrame, model: Model, base: np.ndarray) -> tuple[Model, float]:
    """The next model and the log-likelihood under this one: counts per task, added up
    by their place."""
    states = len(model.start)
    held = texts.sparkSession.sparkContext.broadcast(model.single())
    # Places: transitions from each state, the start, then the symbols; before them,
    # at -1, the log-likelihood.
    schema = "place int, " + ", ".join(f"s{k} double" for k in range(states))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        counts, likelihood = zeros(own), np.zeros((1, states))
        for part in batches:
            for _, lengths, symbols in side_by_side(pieces(part["symbols"]), TOGETHER):
                likelihood[0, 0] += expected(own, lengths, symbols, counts)
        rows = np.concatenate([likelihood, counts[1], counts[0][None, :], counts[2]])
        some = np.flatnonzero(rows.any(axis=1))
        yield batch(
            schema, pa.array((some - 1).astype(np.int32)), *(pa.array(rows[some, k]) for k in range(states))
        )

    sums = (
        map_batches(texts.select("symbols"), step, schema)
        .groupBy("place")
        .agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(states)))
        .toPandas()
    )
    rows = np.zeros((states + 2 + len(base), states))
    rows[sums["place"].to_numpy(np.int64) + 1] = sums[[f"s{k}" for k in range(states)]].to_numpy()
    likelihood, rows = float(rows[0, 0]), rows[1:]
    return Model.of_counts(rows[states], rows[:states], rows[states + 1 :], base), likelihood


def train(texts: DataFrame, known: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """``texts`` holds the training rows, encoded."""
    base = known.base()
    model = Model.first(base, states)
    share = min(1.0, START_TEXTS / max(1, known.ends))
    chosen = F.pmod(F.xxhash64("doc_id", "symbols"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = [
        np.frombuffer(row[0], "<u2").astype(np.int64)
        for row in texts.filter(chosen & (F.col("n_tokens") <= START_TOKENS))
        .select("symbols")
        .limit(2 * START_TEXTS)
        .collect()
    ]
    sample.sort(key=lambda t: t.tobytes())
    for _ in range(START_ROUNDS if sample else 0):
        counts = zeros(model)
        for _, lengths, symbols in side_by_side(sample, TOGETHER):
            expected(model, lengths, symbols, counts)
        model = Model.of_counts(*counts, base)
    # EM's gains fall by about the same factor each round, so the last two tell what the
    # model that is at hand by then, one round on, would still gain.
    values: list[float] = []
    while True:
        model, likelihood = _round(texts, model, base)
        values.append(likelihood)
        if len(values) > max(rounds, 2) and known.total:
            first, last = values[-2] - values[-3], values[-1] - values[-2]
            if last <= 0 or last * min(1.0, last / max(first, last)) <= SETTLED * known.total:
                return model
        elif not known.total:
            return model


COUNTED = "token long, c binary"


def merged(tokens: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of counts by token."""
    token, at = np.unique(np.concatenate(tokens), return_inverse=True)
    rows = np.concatenate(counts)
    return token, np.stack([np.bincount(at, rows[:, k], len(token)) for k in range(rows.shape[1])], axis=1)


def learned(texts: DataFrame, model: Model, known: Vocabulary) -> DataFrame:
    """(token, c): expected counts by state of the tokens behind ``other``, packed as
    one float for each state. Tasks add up what they hold before it is shuffled."""
    states = len(model.start)
    context = texts.sparkSession.sparkContext
    held = context.broadcast((model.single(), known.token, known.other))

    def packed(token: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        bits = rows.astype("<f4").tobytes()
        size = 4 * rows.shape[1]
        return batch(COUNTED, pa.array(token), [bits[i : i + size] for i in range(0, len(bits), size)])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, heavy, other = held.value
        own = Model(*plain)
        tokens: list[np.ndarray] = []
        sums: list[np.ndarray] = []
        for part in batches:
            # Codes of the other tokens of all texts, rare ones by place in the whole list.
            others = [np.frombuffer(x, "<i4") for x in part["others"].to_pylist()]
            rare = part["rare"]
            starts = np.concatenate([[0], np.cumsum(pc.list_value_length(rare).fill_null(0).to_numpy())])
            code = np.concatenate([np.zeros(0, np.int64), *others])
            shift = np.repeat(starts[:-1], [len(x) for x in others])
            names = np.concatenate([heavy, rare.flatten().to_numpy()])
            code[code >= len(heavy)] += shift[code >= len(heavy)]
            token, at = np.unique(names[code], return_inverse=True)
            # Symbols of their own are label 0; pieces are cut alike.
            counts = zeros(own)
            counts[2] = np.zeros((len(token) + 1, states))
            texts_ = pieces(part["symbols"])
            whole = np.concatenate([np.zeros(0, np.int64), *texts_])
            label = np.zeros(len(whole), np.int64)
            label[whole == other] = at + 1
            cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts_], dtype=np.int64)])
            for chosen, lengths, found in side_by_side(texts_, TOGETHER):
                labels = np.concatenate([label[cuts[i] : cuts[i + 1]] for i in chosen])
                expected(own, lengths, found, counts, labels)
            tokens.append(token)
            sums.append(counts[2][1:].astype(np.float32))
            if sum(map(len, tokens)) > 4 * DISTINCT:
                token, rows = merged(tokens, sums)
                tokens, sums = [token], [rows.astype(np.float32)]
                if len(token) > 2 * DISTINCT:
                    yield packed(token, rows)
                    tokens, sums = [], []
        if tokens:
            yield packed(*merged(tokens, sums))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a token follow one another; a token may reach into the next batch.
        token, rows = np.zeros(0, np.int64), np.zeros((0, states))
        for part in batches:
            bits = np.frombuffer(b"".join(part["c"].to_pylist()), "<f4").reshape(-1, states)
            token, rows = merged([token, part["token"].to_numpy()], [rows, bits.astype(np.float64)])
            last = part["token"][len(part) - 1].as_py() if len(part) else None
            open_ = token == last
            yield packed(token[~open_], rows[~open_])
            token, rows = token[open_], rows[open_]
        yield packed(token, rows)

    made = map_batches(texts.select("symbols", "others", "rare"), step, COUNTED)
    return map_batches(made.repartition("token").sortWithinPartitions("token"), added, COUNTED)


TILTED = "token long, n long, tilt binary"


def tilted(counts: DataFrame, found: DataFrame, states: int) -> DataFrame:
    """(token, n, tilt) of the tokens in ``found``; tilts are packed floats by state."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(states)
        for part in batches:
            sums += np.frombuffer(b"".join(part["c"].to_pylist()), "<f4").reshape(-1, states).sum(axis=0, dtype=float)
        yield batch("sums array<double>", [sums.tolist()])

    parts = map_batches(found.select("c"), summed, "sums array<double>")
    rows = parts.agg(*(F.sum(F.col("sums")[k]) for k in range(states))).first()
    sums = np.array([x or 0.0 for x in rows])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = sums.sum() / np.maximum(sums, 1e-9)
        for part in batches:
            c = np.frombuffer(b"".join(part["c"].to_pylist()), "<f4").reshape(-1, states)
            tilt = ((c * scale + 1) / (part["n"].to_numpy()[:, None] + 1)).astype("<f4").tobytes()
            size = 4 * states
            yield batch(TILTED, part["token"], part["n"], [tilt[i : i + size] for i in range(0, len(tilt), size)])

    return map_batches(counts.join(found, "token").select("token", "n", "c"), step, TILTED)


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_known double, "
    "rest double"
)


def _scored(texts: DataFrame, model: Model, known: Vocabulary, tilts: np.ndarray) -> DataFrame:
    """Per text, the model's score but for the base score: they add up to the score.
    ``tilts`` are those of the heavy tokens; ``found`` has those of the text's rare ones."""
    held = texts.sparkSession.sparkContext.broadcast((model.plain(), tilts, known.other))
    scale = log10(known.scale)
    base_other = log10(float(known.base()[known.other]))
    states = len(model.start)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, heavy, other = held.value
        own = Model(*plain)
        held_back: list[pa.RecordBatch] = []
        size = 0
        for part in batches:
            held_back.append(part)
            size += int(part["n_tokens"].to_numpy().sum())
            if size >= TOGETHER:
                yield scored(held_back, own, heavy, other)
                held_back, size = [], 0
        if held_back:
            yield scored(held_back, own, heavy, other)

    def scored(parts: list[pa.RecordBatch], own: Model, heavy: np.ndarray, other: int) -> pa.RecordBatch:
        part = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        found = [np.frombuffer(x, "<u2") for x in part["symbols"].to_pylist()]
        # Rows of tilts: none, the heavy tokens, then the texts' rare ones.
        lists = part["found"]
        pairs = lists.flatten()
        bits = np.frombuffer(b"".join(pairs.field("tilt").to_pylist()), "<f4").reshape(-1, states)
        table = np.concatenate([np.ones((1, states), np.float32), heavy, bits])
        at = pairs.field("at").to_numpy()
        sizes = np.array([x or 0 for x in pc.list_value_length(lists).to_pylist()], np.int64)
        tops = np.concatenate([[0], np.cumsum(sizes)])
        places = []
        for i, (symbols, others) in enumerate(zip(found, part["others"].to_pylist(), strict=True)):
            code = np.frombuffer(others, "<i4")
            row_of = np.zeros(1 + max(0, int(code.max(initial=-1)) + 1 - len(heavy)), np.int32)
            mine = at[tops[i] : tops[i + 1]]
            row_of[mine] = np.arange(tops[i], tops[i + 1]) + 1 + len(heavy)
            light = code >= len(heavy)
            place = np.zeros(len(symbols), np.int32)
            place[symbols == other] = np.where(light, row_of[np.where(light, code - len(heavy), 0)], code + 1)
            places.append(place)
        value = np.zeros(len(found))
        for chosen, lengths, symbols in side_by_side(found, TOGETHER):
            place = np.concatenate([places[i] for i in chosen])
            value[chosen] = forward(own, lengths, symbols, table, place) / log(10)
        n, n_other = (part[c].to_numpy() for c in ("n_tokens", "n_other"))
        # Take the symbols' own base score away; it is part of the base score.
        value -= part["log_symbols"].to_numpy() - (n - n_other) * scale
        value -= n_other * base_other
        kept = (part[c] for c in ("row", "doc_id", "held_out", "n_tokens", "n_known", "log_known"))
        return batch(SCORED, *kept, pa.array(value))

    columns = ["row", "doc_id", "held_out", "n_tokens", "n_known", "log_known", "n_other", "log_symbols", "symbols", "others", "found"]
    return map_batches(texts.select(*columns), step, SCORED)


def scores(docs: DataFrame, held_out: Column, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    document; rows where the condition ``held_out`` is true train nothing."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    training = rows.filter(~F.col("held_out"))
    counts = stored(token_counts(training.select("text")), "hmm-counts")
    known = vocabulary(counts, training.select("held_out").count())
    texts = stored(
        encoded(rows, known).withColumn("row", F.monotonically_increasing_id()), "hmm-texts", "zstd"
    )
    model = train(texts.filter(~F.col("held_out")), known, states, rounds)
    behind = stored(learned(texts.filter(~F.col("held_out")), model, known), "hmm-learned")
    token = stored(tilted(counts, behind, states), "hmm-tilts")
    light = F.col("n") < F.lit(HEAVY * known.total)
    tilts = np.ones((len(known.token), states), np.float32)
    # As many as the vocabulary holds at most.
    heavy = token.filter(~light).select("token", "tilt").toPandas()
    if len(heavy):
        rows = np.frombuffer(b"".join(heavy["tilt"]), "<f4").reshape(-1, states)
        tilts[np.searchsorted(known.token, heavy["token"].to_numpy(np.int64))] = rows
    rare = texts.filter(F.size("rare") > 0).select(
        "row", F.posexplode(F.arrays_zip("rare", "rare_n")).alias("at", "r")
    )
    found = (
        rare.select("row", "at", F.col("r.rare").alias("token"), F.col("r.rare_n").alias("times"))
        .join(token.filter(light), "token")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_rare"),
            F.sum("times").alias("n_rare"),
            F.collect_list(F.struct("at", "tilt")).alias("found"),
        )
    )
    whole = texts.drop("rare", "rare_n").join(found, "row", "left").withColumns(
        {
            "n_known": F.col("n_heavy") + F.coalesce("n_rare", F.lit(0)),
            "log_known": F.col("log_heavy") + F.coalesce("log_rare", F.lit(0.0)),
        }
    )
    base = F.col("log_known") - F.col("n_tokens") * F.lit(log10(known.scale))
    return _scored(whole, model, known, tilts).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(int(known.total)).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("rest")).alias("score"),
    )


def report(docs: DataFrame, modulus: int = 7, held_out: int = 2) -> DataFrame:
    return scores(docs, split_of("doc_id", modulus) == held_out)
