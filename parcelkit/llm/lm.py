"""Language-model scoring: a gated recurrent network trained here in numpy.

Texts are words and an end token each. Counts of all training tokens are
gathered first; the network knows the ``MODEL_WORDS`` most frequent ones, the
end token and one token for all other words. It is a GRU with a
class-factored softmax: words are sorted by count and cut into classes of 32,
and a word's probability is that of its class times that of the word in the
class. A word outside the network's vocabulary has the probability of the
other-word token times its smoothed share among other words.

Training is truncated backpropagation through time over all training texts:
windows of 32 tokens, gradients cut at window ends, the state carried over;
texts longer than 512 tokens are trained on in spans of that length, each
after its preceding token, so that few long texts do not run alone.
Every task trains a copy on its own texts and copies are averaged after each
round; a round takes the texts of one hash class, so all rounds together read
each text once. Scoring carries the state through all windows of a text, so
a score is the whole text's log-likelihood.

Word counts of any vocabulary: the most frequent words (a bounded number) are
sent to all tasks; the others are joined by word.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelkit.llm.common import prepare, row_key
from parcelkit.session import materialize

MODEL_WORDS = 1022
CLASS = 32
EMBED, HIDDEN = 16, 16
WINDOW = 32
ROUNDS = 3
SPAN = 512             # a longer text is trained on in spans of that many tokens
TRAIN_DOCS = 512       # spans that are trained on side by side
GROUP_TOKENS = 1_000_000
SCORED_TOKENS = 4_000_000  # tokens of the texts that are gathered to be scored, about
SCORED_TEXTS = 1024        # texts of like lengths that are scored side by side
OUTPUT_TOKENS = 16_384  # tokens of a scoring window, or more
RATE = 0.01
CLIP = 1.0
SEED = 11
# Different words that a task counts before it passes their counts on.
COUNTED = 150_000
# Words whose counts every task holds: a dictionary of at most that size.
KNOWN = 200_000
END = b""


def tokenize(text: bytes | None) -> list:
    """Lower-cased words of UTF-8 bytes (A-Z and ASCII blanks only), and the
    end."""
    words = text.lower().split() if text else []
    words.append(END)
    return words


def _texts(column) -> list:
    """A string column as UTF-8 bytes: nothing is decoded."""
    return column.cast(pa.binary()).to_pylist()


# --- the network --------------------------------------------------------------------

SHAPES = {"E": (MODEL_WORDS + 2, EMBED), "Wx": (EMBED, 3 * HIDDEN), "b": (3 * HIDDEN,), "U": (HIDDEN, 3 * HIDDEN),
          "bu": (3 * HIDDEN,), "Wc": (HIDDEN, (MODEL_WORDS + 2) // CLASS), "bc": ((MODEL_WORDS + 2) // CLASS,),
          "Ww": ((MODEL_WORDS + 2) // CLASS, HIDDEN, CLASS), "bw": ((MODEL_WORDS + 2) // CLASS, CLASS)}


def initial(counts: np.ndarray) -> dict:
    """Small random weights; output biases are the tokens' log shares, so the
    untrained network is the unigram model of its vocabulary."""
    rng = np.random.default_rng(SEED)
    p = {k: (rng.standard_normal(s) * (0.1 if k == "E" else 1 / math.sqrt(s[-2] if len(s) > 1 else 1))).astype(np.float32)
         for k, s in SHAPES.items()}
    share = (counts + 0.5).reshape(-1, CLASS)
    p["Wc"] *= 0.1
    p["Ww"] *= 0.1
    p["b"][:], p["bu"][:] = 0, 0
    p["bc"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
    p["bw"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    return p


def pack(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def unpack(flat: np.ndarray) -> dict:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = math.prod(s)
        out[k] = flat[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _step(ew, h, u, bu):
    """One GRU step: gates, candidate and new state."""
    k = HIDDEN
    hu = h @ u + bu
    zr = _sigmoid(ew[:, :2 * k] + hu[:, :2 * k])
    z, r = zr[:, :k], zr[:, k:]
    c = np.tanh(ew[:, 2 * k:] + r * hu[:, 2 * k:])
    return z, r, c, hu[:, 2 * k:], c + z * (h - c)


def _halved_gates(w: np.ndarray) -> np.ndarray:
    """Weights with the two gates' part halved: sigmoid(x) is 0.5 tanh(x / 2)
    + 0.5, and halving is exact."""
    return w * np.repeat(np.array([0.5, 1], dtype=np.float32), [2 * HIDDEN, HIDDEN])


def _next_state(ew, h, u, bu):
    """The new state alone, from weights of halved gates, with few temporary
    arrays; the same numbers as ``_step``."""
    k = HIDDEN
    hu = h @ u
    hu += bu
    zr = ew[:, :2 * k] + hu[:, :2 * k]
    np.tanh(zr, out=zr)
    zr *= 0.5
    zr += 0.5
    c = zr[:, k:] * hu[:, 2 * k:]
    c += ew[:, 2 * k:]
    np.tanh(c, out=c)
    h = h - c
    h *= zr[:, :k]
    h += c
    return h


def _output(p: dict, h: np.ndarray, target: np.ndarray, grads: dict | None = None):
    """Log probabilities of targets; with ``grads``, adds the gradients of
    their negative mean and returns the gradient of h too."""
    cls, within = target // CLASS, target % CLASS
    n = len(target)

    def softmax(w, bias, x, at):
        """Log probabilities of ``at`` per row of x, and the gradient of the
        logits; laid out by class, so that sums run along the rows."""
        logits = w.T @ x.T
        logits += bias[:, None]
        logits -= logits.max(axis=0)
        i = np.arange(len(at))
        found = logits[at, i]
        e = np.exp(logits, out=logits)
        total = e.sum(axis=0)
        found -= np.log(total)
        if grads is not None:
            e /= total
            e[at, i] -= 1
            e /= n
        return found, e

    logp, d = softmax(p["Wc"], p["bc"], h, cls)
    dh = None
    if grads is not None:
        grads["Wc"] += (d @ h).T
        grads["bc"] += d.sum(axis=1)
        dh = d.T @ p["Wc"].T
    # Rows by class, so that a class is a slice of them.
    order = np.argsort(cls.astype(np.uint8), kind="stable")  # small numbers sort by radix
    edges = np.r_[0, np.cumsum(np.bincount(cls, minlength=len(p["bc"])))]
    h, within, logp_in = h[order], within[order], logp[order]
    dh_in = dh[order] if grads is not None else None
    for c in np.flatnonzero(np.diff(edges)):
        rows = slice(edges[c], edges[c + 1])
        found, d = softmax(p["Ww"][c], p["bw"][c], h[rows], within[rows])
        logp_in[rows] += found
        if grads is not None:
            grads["Ww"][c] += (d @ h[rows]).T
            grads["bw"][c] += d.sum(axis=1)
            dh_in[rows] += d.T @ p["Ww"][c].T
    logp[order] = logp_in
    if grads is not None:
        dh[order] = dh_in
    return logp, dh


class Texts:
    """Token numbers of several texts, longest first, walked in windows: the
    texts still running at a step are always the first ones. ``before`` is
    the token ahead of each text, the end token for a whole one."""

    def __init__(self, ids: np.ndarray, start: np.ndarray, size: np.ndarray, before: np.ndarray):
        self.order = np.argsort(-size, kind="stable")
        self.ids, self.size = ids, size[self.order]
        self.starts, self.before = start[self.order], before[self.order]

    def windows(self, length):
        """(targets per step, inputs per step) of each window in turn;
        ``length`` gives a window's steps from the number of texts in it."""
        last, at, end = self.before, 0, int(self.size[0]) if len(self.size) else 0
        while at < end:
            targets, inputs = [], []
            for t in range(at, min(end, at + length(int(np.searchsorted(-self.size, -at, side="left"))))):
                n = int(np.searchsorted(-self.size, -t, side="left"))
                now = self.ids[self.starts[:n] + t]
                inputs.append(last[:n])
                targets.append(now)
                last = now
            at += len(targets)
            yield targets, inputs


def whole_texts(ids: np.ndarray, size: np.ndarray, end: int) -> Texts:
    return Texts(ids, np.cumsum(size) - size, size, np.full(len(size), end, dtype=ids.dtype))


def spans(ids: np.ndarray, size: np.ndarray, end: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, token before) of the pieces of at most ``length`` tokens
    that the texts are cut into."""
    n = -(-size // length)
    doc = np.repeat(np.arange(len(size)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = (np.cumsum(size) - size)[doc] + k * length
    return start, np.minimum(length, size[doc] - k * length), np.where(k > 0, ids[start - 1], end).astype(ids.dtype)


def score_texts(p: dict, ids: np.ndarray, size: np.ndarray, end: int) -> np.ndarray:
    """Natural-log likelihood of each text under the network. The state goes
    through all of a text; windows only group the output layer's work, so
    they are longer where fewer texts run. Texts of like lengths run side by
    side, so that the steps of the longest are made for these alone."""
    ew, u, bu = (_halved_gates(w) for w in (p["E"] @ p["Wx"] + p["b"], p["U"], p["bu"]))
    starts, before = np.cumsum(size) - size, np.full(len(size), end, dtype=ids.dtype)
    order = np.argsort(-size, kind="stable")
    back = np.empty(len(size))
    for lo in range(0, len(order), SCORED_TEXTS):
        mine = order[lo:lo + SCORED_TEXTS]
        texts = Texts(ids, starts[mine], size[mine], before[mine])
        h = np.zeros((len(mine), HIDDEN), dtype=np.float32)
        out = np.zeros(len(mine))
        for targets, inputs in texts.windows(lambda n: max(WINDOW, OUTPUT_TOKENS // n)):
            states = []
            for x in inputs:
                h = _next_state(ew[x], h[:len(x)], u, bu)
                states.append(h)
            logp, _ = _output(p, np.concatenate(states), np.concatenate(targets))
            who = np.concatenate([np.arange(len(x)) for x in inputs])
            out[:len(inputs[0])] += np.bincount(who, logp, minlength=len(inputs[0]))
        back[mine[texts.order]] = out
    return back


class Trainer:
    """Adam over truncated backpropagation through time."""

    def __init__(self, p: dict):
        self.p = {k: v.copy() for k, v in p.items()}
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.steps = 0

    def texts(self, ids: np.ndarray, size: np.ndarray, end: int) -> None:
        """All tokens of the texts once, in batches of spans side by side."""
        start, length, before = spans(ids, size, end, SPAN)
        order = np.argsort(-length, kind="stable")
        for lo in range(0, len(order), TRAIN_DOCS):
            mine = order[lo:lo + TRAIN_DOCS]
            h = np.zeros((len(mine), HIDDEN), dtype=np.float32)
            for targets, inputs in Texts(ids, start[mine], length[mine], before[mine]).windows(lambda n: WINDOW):
                h = self.window(targets, inputs, h)

    def window(self, targets: list, inputs: list, h: np.ndarray) -> np.ndarray:
        """One update; returns the state that the next window starts from."""
        p, k = self.p, HIDDEN
        ew = p["E"] @ p["Wx"] + p["b"]
        trace, states = [], []
        for x in inputs:
            h = h[:len(x)]
            z, r, c, hu, new = _step(ew[x], h, p["U"], p["bu"])
            trace.append((h, z, r, c, hu))
            states.append(new)
            h = new
        g = {n: np.zeros_like(v) for n, v in p.items()}
        _, dout = _output(p, np.concatenate(states), np.concatenate(targets), g)
        at = np.cumsum([0, *map(len, inputs)])
        dh = np.zeros((0, k), dtype=np.float32)
        old, z, r, c, hu = (np.concatenate(a) for a in zip(*trace))
        dc_c, dz_c, not_z, not_r = 1 - c * c, old - c, 1 - z, 1 - r
        gate = np.empty((len(z), 3 * k), dtype=np.float32)
        for t in range(len(inputs) - 1, -1, -1):
            s = slice(at[t], at[t + 1])
            d = dout[s]
            d[:len(dh)] += dh
            dc = d * not_z[s]
            dc *= dc_c[s]
            dz = d * dz_c[s]
            dz *= z[s]
            dz *= not_z[s]
            dr = dc * hu[s]
            dr *= r[s]
            dr *= not_r[s]
            gate[s, :k], gate[s, k:2 * k], gate[s, 2 * k:] = dz, dr, dc
            rec = gate[s].copy()
            rec[:, 2 * k:] *= r[s]
            g["U"] += old[s].T @ rec
            g["bu"] += rec.sum(axis=0)
            dh = d * z[s]
            dh += rec @ p["U"].T
        x = np.concatenate(inputs)
        order = np.argsort(x.astype(np.uint16), kind="stable")
        count = np.bincount(x, minlength=len(ew))
        seen = np.flatnonzero(count)
        dew = np.zeros_like(ew)
        dew[seen] = np.add.reduceat(gate[order], (np.cumsum(count) - count)[seen], axis=0)
        g["E"], g["Wx"], g["b"] = dew @ p["Wx"].T, p["E"].T @ dew, dew.sum(axis=0)
        self._update(g)
        return h

    def _update(self, g: dict) -> None:
        norm = math.sqrt(sum(float((x * x).sum()) for x in g.values()))
        scale = min(1.0, CLIP / norm) if norm else 1.0
        self.steps += 1
        fix1, fix2 = 1 - 0.9 ** self.steps, 1 - 0.999 ** self.steps
        for n, x in g.items():
            x = x * scale
            self.m[n] += 0.1 * (x - self.m[n])
            self.v[n] += 0.001 * (x * x - self.v[n])
            self.p[n] -= RATE * (self.m[n] / fix1) / (np.sqrt(self.v[n] / fix2) + 1e-6)


# --- Spark --------------------------------------------------------------------------

def _count(batches):
    """(word, c): the batch counts of a task, summed over some batches."""
    counts: Counter = Counter()
    for batch in batches:
        for text in _texts(batch.column("text")):
            counts.update(tokenize(text))
        if len(counts) > COUNTED:
            yield _counted(counts)
            counts = Counter()
    if counts:
        yield _counted(counts)


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                      names=["word", "c"])


class Vocabulary:
    """The most frequent words with their counts, and the network's numbers.

    Words are numbered by count; the first MODEL_WORDS are the network's. The
    network's tokens, sorted by count, take the places 0, 1, ... of its
    classes.
    """

    def __init__(self, words: list, counts: list, end_count: int, total: int, distinct: int):
        self.blob, self.counts = b" ".join(words), np.array(counts, dtype=np.int64)
        self.total, self.distinct = total, distinct
        self.key = uuid.uuid4().hex  # workers outlive a vocabulary
        own = self.counts[:MODEL_WORDS]
        other = max(0, total - end_count - int(own.sum()))
        tokens = np.zeros(MODEL_WORDS + 2, dtype=np.int64)
        tokens[:len(own)], tokens[-2], tokens[-1] = own, other, end_count
        place = np.argsort(-tokens, kind="stable")
        number = np.empty_like(place)
        number[place] = np.arange(len(place))
        self.token_counts, self.number = tokens[place], number
        self.end, self.other = int(number[-1]), int(number[-2])
        self.end_count = end_count
        # Denominator of a word among the other words; one for any unseen.
        self.other_total = other + max(0, distinct - len(own) - 1) + 1

    def ranks(self) -> dict:
        return {w: i for i, w in enumerate(self.blob.split(b" "))} if self.blob else {}


_RANKS: dict = {}


def _ranks(vocabulary: Vocabulary) -> dict:
    """The word numbers, built once in a worker process."""
    if vocabulary.key not in _RANKS:
        _RANKS.clear()
        _RANKS[vocabulary.key] = vocabulary.ranks()
    return _RANKS[vocabulary.key]


def _numbered(texts: list, ranks: dict) -> tuple[list, np.ndarray, np.ndarray]:
    """(tokens, rank or -1 of each, tokens per text); the end has rank -2."""
    words, size = [], []
    for t in texts:
        w = tokenize(t)
        words += w
        size.append(len(w))
    size = np.array(size, dtype=np.int64)
    rank = np.fromiter(map(ranks.get, words, repeat(-1)), dtype=np.int32, count=len(words))
    rank[np.cumsum(size) - 1] = -2
    return words, rank, size


def _tokens(rank: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Network tokens of word ranks."""
    own = (rank >= 0) & (rank < MODEL_WORDS)
    return np.where(own, v.number[np.where(own, rank, 0)], np.where(rank == -2, v.end, v.other)).astype(np.int32)


def _gathered(batches):
    """Batches joined to about GROUP_TOKENS tokens' worth of text."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column("text").nbytes
        if size > 6 * GROUP_TOKENS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _train(shared):
    def run(batches):
        v, flat = shared.value
        ranks, trainer, seen = _ranks(v), Trainer(unpack(flat)), 0
        for table in _gathered(batches):
            _, rank, size = _numbered(_texts(table.column("text")), ranks)
            trainer.texts(_tokens(rank, v), size, v.end)
            seen += len(rank)
        if seen:
            values = pack(trainer.p).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values))), pa.array(values * seen), pa.array(np.full(len(values), seen))],
                names=["i", "x", "n"])
    return run


def _side_by_side(batches, ranks: dict):
    """(a, b, words without a rank, ranks, tokens per text) of the texts of
    about SCORED_TOKENS tokens each: a step of the network costs about as much
    for one text as for some tens, so many texts are sorted by length. Of the
    texts only numbers and the words without one are held."""
    held, tokens = [], 0

    def joined():
        a, b, words, rank, size = zip(*held)
        return np.concatenate(a), np.concatenate(b), [w for ws in words for w in ws], np.concatenate(rank), np.concatenate(size)

    for batch in batches:
        words, rank, size = _numbered(_texts(batch.column("text")), ranks)
        if not len(size):
            continue
        held.append((*(batch.column(c).to_numpy() for c in "ab"), [words[i] for i in np.flatnonzero(rank == -1).tolist()], rank, size))
        tokens += len(rank)
        if tokens >= SCORED_TOKENS:
            yield joined()
            held, tokens = [], 0
    if held:
        yield joined()


def _score(shared):
    """Rows of two kinds: a text's own sums, and its words without a known
    count (word not null)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("word", pa.binary()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("log_counts", pa.float64()), ("log_network", pa.float64()),
                        ("log_other", pa.float64()), ("n_other", pa.int64())])

    def run(batches):
        v, flat = shared.value
        ranks, p = _ranks(v), unpack(flat)
        logs = np.log10(np.r_[v.counts, v.end_count, 0] + 1.0)  # by rank; -2: the end, -1: not known here
        known = np.r_[v.counts, v.end_count, 0] > 0
        for a, b, words, rank, size in _side_by_side(batches, ranks):
            cold = np.flatnonzero(rank == -1)
            network = score_texts(p, _tokens(rank, v), size, v.end) / math.log(10)
            who = np.repeat(np.arange(len(size)), size)
            total = lambda x: np.bincount(who, x, minlength=len(size))
            other = (rank >= MODEL_WORDS) | (rank == -1)
            n = len(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.nulls(n, pa.binary()), pa.array(size),
                 pa.array(total(known[rank]).astype(np.int64)), pa.array(total(logs[rank])), pa.array(network),
                 pa.array(total(np.where(other, logs[rank], 0.0))), pa.array(total(other).astype(np.int64))], schema=schema)
            for lo in range(0, len(cold), 100_000):
                c = cold[lo:lo + 100_000]
                none = lambda t: pa.nulls(len(c), t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[who[c]]), pa.array(b[who[c]]), pa.array(words[lo:lo + 100_000], pa.binary()),
                     *(none(f.type) for f in list(schema)[3:])], schema=schema)
    return run


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words (word, c) of the highest counts, all of a count or none, so
    that they are at most ``most``. A sort with a limit would send so many
    words from every task to the driver; here one number goes there, found
    from the words per count (n words of distinct counts have n * n / 2
    tokens at least, so that table stays small)."""
    per = counts.groupBy("c").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, 0))
    least = per.select("c", upto.alias("upto")).where(F.col("upto") <= most).agg(F.min("c")).first()[0]
    return counts.where(F.col("c") >= (least if least is not None else 1 << 62))


def train(texts: DataFrame, rounds: int = ROUNDS) -> tuple[Vocabulary, np.ndarray, DataFrame]:
    """Vocabulary, network weights and the table (word, c) of all training
    words, learned from column text of every row."""
    spark = texts.sparkSession
    sc = spark.sparkContext
    counts = materialize(texts.mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")),
                         "lm-counts")
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"),
                      F.sum(F.when(F.col("word") == F.lit(END), F.col("c")).otherwise(0)).alias("e")).first()
    top = sorted(((-r["c"], bytes(r["word"])) for r in most_frequent(counts.where(F.col("word") != F.lit(END)), KNOWN).collect()))
    v = Vocabulary([w for _, w in top], [-c for c, _ in top], sums["e"] or 0, sums["n"] or 0, sums["v"])
    flat = pack(initial(v.token_counts)).astype(np.float64)
    # The hash decides a text's round, so that copies of rows train together
    # and every text trains once.
    turn = F.pmod(F.xxhash64(F.lit(SEED), "text"), F.lit(rounds))
    for r in range(rounds):
        shared = sc.broadcast((v, flat))  # a bounded vocabulary and a fixed number of weights
        trained = texts.where(turn == r).mapInArrow(_train(shared), "i long, x double, n long")
        mean = trained.groupBy("i").agg((F.sum("x") / F.sum("n")).alias("x")).collect()
        for row in mean:
            flat[row["i"]] = row["x"]
    return v, flat, counts


def score(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score and score, log10 probabilities of the whole text
    under the smoothed unigram counts and under the network; both are learned
    from the rows where the column ``held_out`` is false (null: false).

    Null texts are empty: the end token alone. Repeated rows count and train
    each; rows are told apart by id and text, which their scores depend on.
    Without training rows all counts are 0 and the network is untrained; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("k"),
                       F.col(f"`{text}`").alias("text"))
    v, flat, counts = train(base.where(~F.col("held_out")).select("text"), rounds)
    shared = spark.sparkContext.broadcast((v, flat))
    rows = materialize(base.select(F.col("k.a").alias("a"), F.col("k.b").alias("b"), "text").mapInArrow(
        _score(shared),
        "a long, b long, word binary, n_tokens long, n_known long, log_counts double, log_network double, "
        "log_other double, n_other long"), "lm-rows")
    ids = base.select("doc_id", "held_out", F.col("k.a").alias("a"), F.col("k.b").alias("b"))
    # Rows equal in id and text have equal sums: one of them is enough.
    own = rows.where("word is null").drop("word").dropDuplicates(["a", "b"])
    copies = ids.groupBy("a", "b").agg(F.count("*").alias("copies"))
    cold = (rows.where("word is not null").select("a", "b", "word").join(counts, "word").groupBy("a", "b")
            .agg(F.sum(F.log10(F.col("c") + 1.0)).alias("cold"), F.count("*").alias("cold_known"))
            .join(copies, ["a", "b"]).select("a", "b", (F.col("cold") / F.col("copies")).alias("cold"),
                                             (F.col("cold_known") / F.col("copies")).cast("long").alias("cold_known")))
    n, d = float(v.total), float(v.distinct)
    all_ = own.join(cold, ["a", "b"], "left").na.fill({"cold": 0.0, "cold_known": 0})
    scored = all_.select(
        "a", "b", "n_tokens", (F.col("n_known") + F.col("cold_known")).alias("n_known"),
        (F.col("log_counts") + F.col("cold") - F.col("n_tokens") * math.log10(n + d + 1)).alias("base_score"),
        (F.col("log_network") + F.col("log_other") + F.col("cold")
         - F.col("n_other") * math.log10(v.other_total)).alias("score"))
    return ids.join(scored, ["a", "b"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(v.total).cast("long").alias("train_tokens"), "base_score", "score")
