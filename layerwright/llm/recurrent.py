"""Language-model scoring with a gated recurrent network and a class-factored softmax.

Word counts cover all training documents.  The most frequent words are the network's vocabulary, in classes of equal size
by rank; every other word belongs to one of ``TAIL`` open classes by its last two bytes, seen before or not.  The network
predicts the class from its state, then, in a closed class, the word; in an open class the word follows the class's
smoothed counts.  The probabilities of all words, unseen ones included, so add up to one.

Texts become 16-bit tokens once; training and scoring read those.  The network is trained by truncated backpropagation on
all training documents, each in one of the rounds: a hash of the document deals it to a shard, every shard trains a replica
in the order of these hashes, replicas are averaged over a tree, weighted by their tokens, and the next round goes on from
the average.  How the table is laid out thus changes scores by rounding only.  In training and in scoring the state is carried across windows from the first word of a document to its
end, so a score is the log-likelihood of the complete document.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import removed, small_batches, stored
from .words import coded_words, slices, split_words, string_hashes, tidy, whole

# Closed classes, words in each (the end of a text is the first word), open classes, size of the state.
CLOSED, MEMBERS, TAIL, STATE = 32, 32, 32, 16
WORDS = CLOSED * MEMBERS
# Words whose counts travel to the tasks; the rest meets its counts in a join.
HEAD = 1 << 18
# Every training document trains the network in one of so many rounds.
ROUNDS = 2
LANES, STEPS, RATE = 128, 24, 0.01
SCORE_LANES, SCORE_STEPS = 512, 32
# Tokens one replica is trained on in a round.
SHARD_TOKENS = 1 << 21
SLICE_BYTES = 6 << 20
END = 0


def sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.tanh(0.5 * x)
    out *= 0.5
    out += 0.5
    return out


def in_order(targets: np.ndarray) -> np.ndarray:
    """The stable order of the targets; numbers of 16 bits are sorted by radix."""
    return np.argsort(targets.astype(np.uint16), kind="stable")


def errors(logits: np.ndarray, targets: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of each column's target and, if there are weights, the gradient of minus its weighted value for the
    logits, which it replaces."""
    columns = np.arange(len(targets))
    logits -= logits.max(axis=0, initial=-np.inf)
    own = logits[targets, columns]
    np.exp(logits, out=logits)
    total = logits.sum(axis=0)
    if weight is not None:
        logits *= weight / total
        logits[targets, columns] -= weight
    return own - np.log(total), logits


@dataclass
class Vocabulary:
    """Counts of the most frequent words, sorted by hash, and totals."""

    hashes: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray
    ends: int  # training documents, and so ends
    tokens: int
    distinct: int
    tail_tokens: np.ndarray
    tail_words: np.ndarray

    def base_total(self) -> float:
        return float(np.log10(self.tokens + 0.5 * (self.distinct + 1)))

    def tail_totals(self) -> np.ndarray:
        return np.log10(self.tail_tokens + 0.5 * (self.tail_words + 1))


def open_class(words: pa.Array) -> np.ndarray:
    """The open class of each word, from its last two bytes."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset + 1 : words.offset + n + 1].astype(np.int64)
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    data = np.frombuffer(data, np.uint8).astype(np.uint32)
    pair = data[ends - 1] + np.where(sizes > 1, data[np.maximum(ends - 2, 0)], 0) * 256
    return ((pair * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64) % TAIL


def lowered_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Word numbers, distinct words and the bounds of the texts."""
    values, bounds = split_words(pc.ascii_lower(texts))
    codes, distinct = coded_words(values)
    return codes, distinct, bounds


def counted_words(training: DataFrame) -> DataFrame:
    """``h, tail, c``: hash, open class and count of every word of the training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                codes, distinct, _ = lowered_words(whole(part["text"]))
                found = {
                    "h": string_hashes(distinct).view(np.int64),
                    "tail": open_class(distinct).astype(np.int32),
                    "n": np.bincount(codes, minlength=len(distinct)),
                }
                yield pa.record_batch(found)

    rows = training.select("text").mapInArrow(tidy(count), "h long, tail int, n long")
    return rows.groupBy("h", "tail").agg(F.sum("n").alias("c"))


def vocabulary(counts: DataFrame, ends: int, head: int) -> Vocabulary:
    """``head`` bounds the part of the counts that is collected."""
    # The cut by classes of counts, so that no task sends more than its share of the head.
    kind = F.floor(F.log2("c") * 64).cast("int")
    least, held = 1 << 30, 0
    for row in sorted(counts.groupBy(kind.alias("kind")).count().collect(), reverse=True):
        held += row["count"]
        if held > head:
            break
        least = row.kind
    top = counts.where(kind >= least).toPandas().sort_values(["c", "h"], ascending=[False, True])
    ranks = np.arange(len(top))
    closed = top.head(WORDS - 1)
    tails = {r.tail: r for r in counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    tail_tokens, tail_words = np.zeros(TAIL, np.int64), np.zeros(TAIL, np.int64)
    for g, r in tails.items():
        own = closed[closed["tail"] == g]
        tail_tokens[g], tail_words[g] = r.c - int(own["c"].sum()), r.n - len(own)
    tokens = sum(r.c for r in tails.values()) + ends
    distinct = sum(r.n for r in tails.values()) + (ends > 0)
    hashes = top.h.to_numpy(np.int64).view(np.uint64)
    by = np.argsort(hashes)
    return Vocabulary(
        hashes[by], top.c.to_numpy(np.int64)[by], ranks[by], ends, tokens, distinct, tail_tokens, tail_words
    )


class Network:
    """Parameters in one flat vector; views of it by name."""

    shapes = {
        "inputs": (WORDS + TAIL, 3 * STATE),
        "recurrent": (STATE, 3 * STATE),
        "classes": (STATE, CLOSED + TAIL),
        "class_bias": (CLOSED + TAIL,),
        "words": (STATE, WORDS),
        "word_bias": (WORDS,),
    }

    def __init__(self, flat: np.ndarray) -> None:
        self.flat = flat.astype(np.float32)
        at = 0
        self.part: dict[str, np.ndarray] = {}
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            self.part[name] = self.flat[at : at + size].reshape(shape)
            at += size

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.shapes.values())

    @classmethod
    def start(cls, known: Vocabulary) -> Network:
        """Small random weights; the biases are the words' own frequencies."""
        rng = np.random.default_rng(7)
        net = cls(rng.normal(scale=0.1, size=cls.size()))
        weight = np.full(WORDS, 0.5)
        weight[END] += known.ends
        closed = known.ranks < WORDS - 1
        weight[known.ranks[closed] + 1] += known.counts[closed]
        by_class = np.concatenate((weight.reshape(CLOSED, MEMBERS).sum(axis=1), known.tail_tokens + 0.5))
        net.part["class_bias"][:] = np.log(by_class / by_class.sum())
        net.part["word_bias"][:] = np.log(weight / weight.sum())
        return net

    def step(self, state: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, tuple]:
        given = self.part["inputs"][tokens]
        pushed = state @ self.part["recurrent"]
        gates = sigmoid(given[:, : 2 * STATE] + pushed[:, : 2 * STATE])
        update, reset = gates[:, :STATE], gates[:, STATE:]
        new = np.tanh(given[:, 2 * STATE :] + reset * pushed[:, 2 * STATE :])
        return new + update * (state - new), (update, reset, new, pushed)

    def logits(self, states: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """For targets in order: logits and numbers of the classes, logits of the words of the closed classes, which come
        first, and these classes' runs of targets with their words.  Logits have a column for each target."""
        kind = np.where(targets < WORDS, targets // MEMBERS, targets - WORDS + CLOSED)
        cuts = np.searchsorted(targets, np.arange(0, WORDS + 1, MEMBERS)).tolist()
        runs = [(cuts[c], cuts[c + 1], slice(c * MEMBERS, (c + 1) * MEMBERS)) for c in range(CLOSED)]
        runs = [r for r in runs if r[1] > r[0]]
        words = np.empty((MEMBERS, cuts[-1]), np.float32)
        for start, stop, span in runs:
            own = self.part["words"][:, span].T @ states[start:stop].T
            np.add(own, self.part["word_bias"][span, None], out=words[:, start:stop])
        return self.part["classes"].T @ states.T + self.part["class_bias"][:, None], kind, words, runs

    def log_probability(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of the class and, in a closed class, of the word."""
        order = in_order(targets)
        targets = targets[order]
        classes, kind, words, _ = self.logits(states[order], targets)
        found = errors(classes, kind)[0]
        found[: words.shape[1]] += errors(words, targets[: words.shape[1]] % MEMBERS)[0]
        out = np.empty_like(found)
        out[order] = found
        return out

    def gradient(self, state: np.ndarray, tokens: np.ndarray, first: np.ndarray, real: np.ndarray):
        """Gradient of the mean loss over a window (steps by lanes), the loss, and the state after it."""
        steps, lanes = tokens.shape
        # The update, reset and new parts each lie in one piece, which numpy goes through fastest.
        given = self.part["inputs"][tokens].reshape(steps, lanes, 3, STATE).transpose(0, 2, 1, 3).copy()
        recurrent = self.part["recurrent"].reshape(STATE, 3, STATE).transpose(1, 0, 2).copy()
        begins = first.any(axis=1).tolist()
        states = np.empty((steps, lanes, STATE), np.float32)
        pushed = np.empty((steps, 3, lanes, STATE), np.float32)
        for t, (own, moved) in enumerate(zip(given, pushed)):
            if begins[t]:
                state = np.where(first[t][:, None], np.float32(0), state)
            states[t] = state
            np.matmul(state, recurrent, out=moved)
            gates, new = own[:2], own[2]
            gates += moved[:2]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            new += gates[1] * moved[2]
            np.tanh(new, out=new)
            state = state - new
            state *= gates[0]
            state += new
        grad = Network(np.zeros(self.size(), np.float32))
        # Everything about the targets goes by their order, in which classes and words are runs.
        targets = tokens.reshape(-1)
        order = in_order(targets)
        targets, flat, weight = targets[order], states.reshape(-1, STATE)[order], real.reshape(-1)[order]
        scale = np.float32(1 / max(weight.sum(), 1))
        classes, kind, words, runs = self.logits(flat, targets)
        closed = words.shape[1]
        logs, error = errors(classes, kind, weight * scale)
        loss = float(logs @ weight)
        grad.part["classes"][:] = (error @ flat).T
        grad.part["class_bias"][:] = error.sum(axis=1)
        back = error.T @ self.part["classes"].T
        logs, error = errors(words, targets[:closed] % MEMBERS, weight[:closed] * scale)
        loss += float(logs @ weight[:closed])
        for start, stop, span in runs:
            own = error[:, start:stop]
            grad.part["words"][:, span] = (own @ flat[start:stop]).T
            grad.part["word_bias"][span] = own.sum(axis=1)
            back[start:stop] += own.T @ self.part["words"][:, span].T
        into = np.empty_like(back)
        into[order] = back
        into = into.reshape(steps, lanes, STATE)
        update, reset, new = given[:, 0], given[:, 1], given[:, 2]
        by_new = (1 - update) * (1 - new * new)
        by = np.empty_like(pushed)
        by[:, 0] = (states - new) * update * (1 - update)
        by[:, 1] = by_new * pushed[:, 2] * reset * (1 - reset)
        by[:, 2] = by_new * reset
        back_recurrent = recurrent.transpose(0, 2, 1).copy()
        later = np.zeros((lanes, STATE), np.float32)
        laters = np.empty((steps, lanes, STATE), np.float32)
        for t in range(steps - 1, -1, -1):
            laters[t] = later
            # From here on what reaches the recurrent products.
            by[t] *= later
            later = later * update[t]
            later += into[t]
            for moved in np.matmul(by[t], back_recurrent):
                later += moved
            if begins[t]:
                later[first[t]] = 0
        by = by.transpose(0, 2, 1, 3).reshape(-1, 3 * STATE)
        grad.part["recurrent"][:] = states.reshape(-1, STATE).T @ by
        by[:, 2 * STATE :] = (by_new * laters).reshape(-1, STATE)
        heads = np.flatnonzero(np.diff(targets, prepend=-1))
        grad.part["inputs"][targets[heads]] = np.add.reduceat(by[order], heads)
        return grad.flat, loss, state


def laid_out(lengths: np.ndarray, lanes: int) -> tuple[list[list[int]], np.ndarray]:
    """Deal texts to lanes of nearly equal length, the longest lane first."""
    lanes = max(min(lanes, len(lengths), int(lengths.sum() // max(lengths.max(), 1)) + 1), 1)
    heap = [(0, k) for k in range(lanes)]
    dealt: list[list[int]] = [[] for _ in range(lanes)]
    for i in np.argsort(-lengths, kind="stable"):
        total, k = heapq.heappop(heap)
        dealt[k].append(int(i))
        heapq.heappush(heap, (total + int(lengths[i]), k))
    totals = np.array([lengths[own].sum() for own in dealt])
    order = np.argsort(-totals, kind="stable")
    return [dealt[k] for k in order], totals[order]


def lane_table(tokens: np.ndarray, edges: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, texts and starts by step and lane, and the length of each lane."""
    lengths = np.diff(edges)
    dealt, totals = laid_out(lengths, lanes)
    table = np.zeros((int(totals[0]), len(dealt)), np.int32)
    text = np.full(table.shape, -1, np.int32)
    for k, own in enumerate(dealt):
        table[: totals[k], k] = np.concatenate([tokens[edges[i] : edges[i + 1]] for i in own])
        text[: totals[k], k] = np.repeat(own, lengths[own])
    return table, text, totals


def starts_of(text: np.ndarray, before: np.ndarray) -> np.ndarray:
    return np.concatenate((before[None], text[:-1])) != text


def scored(net: Network, tokens: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Natural log-probability of each text's classes and closed-class words."""
    total = np.zeros(len(edges) - 1)
    if not len(total):
        return total
    table, text, totals = lane_table(tokens, edges, SCORE_LANES)
    state = np.zeros((len(totals), STATE), np.float32)
    for at in range(0, len(table), SCORE_STEPS):
        active = int(np.searchsorted(-totals, -at))
        own, texts = table[at : at + SCORE_STEPS, :active], text[at : at + SCORE_STEPS, :active]
        before = text[at - 1, :active] if at else np.full(active, -2)
        first = starts_of(texts, before)
        state = state[:active]
        states = np.empty((*own.shape, STATE), np.float32)
        for t in range(len(own)):
            if first[t].any():
                state = np.where(first[t][:, None], np.float32(0), state)
            states[t] = state
            state, _ = net.step(state, own[t])
        real = texts.reshape(-1) >= 0
        found = net.log_probability(states.reshape(-1, STATE)[real], own.reshape(-1)[real])
        total += np.bincount(texts.reshape(-1)[real], weights=found, minlength=len(total))
    return total


def trained(net: Network, tokens: np.ndarray, edges: np.ndarray, moments: list[np.ndarray]) -> int:
    """One pass of truncated backpropagation over the texts with Adam; returns the number of tokens."""
    if len(edges) < 2:
        return 0
    table, text, totals = lane_table(tokens, edges, LANES)
    state = np.zeros((len(totals), STATE), np.float32)
    before = np.full(len(totals), -2)
    for at in range(0, len(table), STEPS):
        own, texts = table[at : at + STEPS], text[at : at + STEPS]
        grad, _, state = net.gradient(state, own, starts_of(texts, before), (texts >= 0).astype(np.float32))
        before = texts[-1]
        grad *= np.float32(min(1.0, 1.0 / max(float(np.sqrt(grad @ grad)), 1e-9)))
        moments[2] += 1
        moments[0] *= np.float32(0.9)
        moments[0] += grad * np.float32(0.1)
        grad *= grad
        grad *= np.float32(0.01)
        moments[1] *= np.float32(0.99)
        moments[1] += grad
        steady = np.sqrt(moments[1], out=grad)
        steady *= np.float32(1 / np.sqrt(1 - 0.99 ** moments[2][0]))
        steady += np.float32(1e-6)
        change = moments[0] / steady
        change *= np.float32(RATE / (1 - 0.9 ** moments[2][0]))
        net.flat -= change
    return int(edges[-1])


def network_tokens(
    known: Vocabulary, codes: np.ndarray, distinct: pa.Array, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's tokens for the network, its end included, with their bounds; place in the head (-1: none) and open class
    of the distinct words."""
    hashes, tail = string_hashes(distinct), open_class(distinct)
    at = np.minimum(np.searchsorted(known.hashes, hashes), max(len(known.hashes) - 1, 0))
    place = np.where(known.hashes[at] == hashes, at, -1) if len(known.hashes) else np.full(len(hashes), -1)
    rank = known.ranks[place] if len(known.hashes) else place
    token = np.where((place >= 0) & (rank < WORDS - 1), rank + 1, WORDS + tail)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out = np.full(len(codes) + len(bounds) - 1, END, np.int64)
    out[np.arange(len(codes)) + owner] = token[codes] if len(codes) else token[:0]
    return out, bounds + np.arange(len(bounds)), place, tail


def prepared(rows: DataFrame, known: Vocabulary) -> DataFrame:
    """What a row's text is reduced to: ``mark`` of the document, its ``tokens``, and scores that need no network."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_total, tail_totals = known.base_total(), known.tail_totals()
        end_score = np.log10(known.ends + 0.5) - base_total
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                codes, distinct, bounds = lowered_words(whole(part["text"]))
                tokens, edges, place, tail = network_tokens(known, codes, distinct, bounds)
                texts = len(bounds) - 1
                owner = np.repeat(np.arange(texts), np.diff(bounds))
                seen = np.where(place >= 0, known.counts[place] if len(known.counts) else 0, 0)
                above = np.where(place >= 0, np.log10(seen + 0.5), 0.0)
                closed = (place >= 0) & (known.ranks[place] < WORDS - 1 if len(known.ranks) else False)
                inner = np.where(closed, 0.0, above - tail_totals[tail])
                add = lambda w: np.bincount(owner, weights=w[codes], minlength=texts)  # noqa: B023, E731
                n_known = np.bincount(owner, weights=(place >= 0)[codes], minlength=texts) + (known.ends > 0)
                # What is not in the head: distinct words of each text with their number.
                far = np.flatnonzero(place[codes] < 0)
                pairs = np.sort((owner[far] << 32) | codes[far])
                heads = np.flatnonzero(np.diff(pairs, prepend=-1))
                pairs, n = pairs[heads], np.diff(heads, append=len(pairs))
                spans = np.searchsorted(pairs >> 32, np.arange(texts + 1)).astype(np.int32)
                hashes = string_hashes(distinct).view(np.int64)
                packed = [None, pa.py_buffer((2 * edges).astype(np.int32)), pa.py_buffer(tokens.astype("<u2"))]
                yield pa.record_batch(
                    {
                        "doc_id": whole(part["doc_id"]),
                        "held_out": whole(part["held_out"]),
                        "mark": whole(part["mark"]),
                        "n_tokens": pa.array(np.diff(edges), pa.int64()),
                        "n_known": pa.array(n_known.astype(np.int64)),
                        "base": pa.array(add(above - base_total) + end_score, pa.float64()),
                        "inner": pa.array(add(inner), pa.float64()),
                        "tokens": pa.Array.from_buffers(pa.binary(), texts, packed),
                        "far": pa.ListArray.from_arrays(spans, pa.array(hashes[pairs & 0xFFFFFFFF], pa.int64())),
                        "far_n": pa.ListArray.from_arrays(spans, pa.array(n, pa.int64())),
                    }
                )

    columns = f"doc_id {kind}, held_out boolean, mark long, n_tokens long, n_known long, base double, inner double"
    marked = rows.select("doc_id", "text", "held_out", F.xxhash64("doc_id", "text").alias("mark"))
    return marked.mapInArrow(tidy(prepare), f"{columns}, tokens binary, far array<long>, far_n array<long>")


def joined_tokens(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts in one piece, and their bounds."""
    texts = whole(column)
    data, bounds = np.frombuffer(b"", "<u2"), np.zeros(1, np.int64)
    if len(texts):
        _, offsets, buffer = texts.buffers()
        bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) // 2
        data = np.frombuffer(buffer, "<u2")[bounds[0] : bounds[-1]]
    return data.astype(np.int64), bounds - bounds[0]


def dealt(training: DataFrame, shards: int, rounds: int) -> DataFrame:
    """``round, shard, mark, chunk, times, tokens``: the training texts, copies of one document counted together.

    A chunk holds as many copies as fill a shard, so a document that makes up much of the corpus is spread over shards.
    """
    copies = training.groupBy("mark", "tokens").agg(F.count("*").alias("n"))
    copies = copies.withColumn("most", F.expr(f"greatest(1L, {2 * SHARD_TOKENS}L div length(tokens))"))
    chunks = copies.withColumn("chunk", F.expr("explode(sequence(0L, (n - 1) div most))"))
    chunks = chunks.withColumn("deal", F.xxhash64("mark", "chunk"))
    return chunks.select(
        F.expr(f"CAST(pmod(deal, {rounds}) AS INT) AS round"),
        F.expr(f"CAST(pmod(shiftright(deal, 8), {shards}) AS INT) AS shard"),
        "mark",
        "chunk",
        F.expr("least(most, n - chunk * most) AS times"),
        "tokens",
    )


def replica(begun: np.ndarray):
    """Training of one shard from these parameters: its parameters times its tokens, and these."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("mark", "ascending"), ("chunk", "ascending")]).combine_chunks()
        rows = np.repeat(np.arange(table.num_rows), table["times"].to_numpy())
        tokens, edges = joined_tokens(table["tokens"].take(pa.array(rows)))
        mine = Network(begun.copy())
        moments = [np.zeros(len(begun), np.float32), np.zeros(len(begun), np.float32), np.zeros(1)]
        seen = trained(mine, tokens, edges, moments)
        return pa.table({"flat": [(mine.flat.astype(np.float64) * seen).tobytes()], "seen": [seen]})

    return run


def fit_network(training: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> Network:
    """Train on every text of ``training`` (``mark, tokens``) once, in one of the rounds."""
    shards = max(round(known.tokens / rounds / SHARD_TOKENS), 1)
    texts, path = stored(dealt(training, shards, rounds), "training")
    net = Network.start(known)
    for n in range(rounds):
        own = texts.where(F.col("round") == n).repartition(shards, "shard").groupBy("shard")
        found = own.applyInArrow(replica(net.flat), "flat binary, seen long").rdd
        found = found.map(lambda r: (np.frombuffer(bytes(r.flat)), r.seen))
        total = found.treeAggregate(
            (0.0, 0), lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a, b: (a[0] + b[0], a[1] + b[1]), depth=3
        )
        if total[1]:
            net = Network(total[0] / total[1])
    removed(training.sparkSession, path)
    return net


def language_scores(documents: DataFrame, held_out: str, head: int = HEAD) -> DataFrame:
    """Log10 probability of every whole text, by word frequency and by the network.

    Learns from the rows where the SQL condition ``held_out`` is not true.  Texts are lower-cased in A-Z; tokens are
    runs of anything but ASCII white space, then one end.  Needs ``doc_id`` and ``text``; other columns, whatever their
    names, are not read.  Returns one row per row: ``doc_id, held_out, n_tokens, n_known`` (tokens seen in training),
    ``train_tokens, base_score`` (smoothed word frequencies) and ``score`` (the network).  A null text is empty: one
    end.  Rows with a null id train like others if the condition is null; repeated rows are texts of their own.
    Without training rows all words are unseen; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    small_batches(spark)
    rows = documents.select("doc_id", "text", F.coalesce(F.expr(held_out), F.lit(False)).alias("held_out"))
    training = rows.where("NOT held_out")
    ends = training.count()
    counts, _ = stored(counted_words(training), "counts")
    known = vocabulary(counts, ends, head)
    first, _ = stored(prepared(rows, known).withColumn("row", F.monotonically_increasing_id()), "texts")
    net = fit_network(first.where("NOT held_out").select("mark", "tokens"), known)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "tokens", SLICE_BYTES):
                model = scored(net, *joined_tokens(part["tokens"])) / np.log(10)
                columns = {c: whole(part[c]) for c in part.column_names if c not in ("tokens", "inner")}
                yield pa.record_batch({**columns, "model": pc.add(whole(part["inner"]), pa.array(model))})

    kept = ["doc_id", "held_out", "n_tokens", "n_known", "base", "row"]
    kinds = {f.name: f.dataType.simpleString() for f in first.schema}
    columns = ", ".join(f"{c} {kinds[c]}" for c in kept)
    result = first.select(*kept, "inner", "tokens").mapInArrow(tidy(score), f"{columns}, model double")
    far = first.select("row", F.explode(F.arrays_zip("far", "far_n")).alias("w"))
    far = far.select("row", F.col("w.far").alias("h"), F.col("w.far_n").alias("n"))
    far = far.join(counts.select("h", "c"), "h", "left")
    sums = far.groupBy("row").agg(
        F.sum(F.expr("n * log10(coalesce(c, 0) + 0.5D)")).alias("above"), F.sum(F.expr("IF(c > 0, n, 0)")).alias("known")
    )
    result = result.join(sums, "row", "left")
    above = F.coalesce("above", F.lit(0.0))
    return result.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + above).alias("base_score"),
        (F.col("model") + above).alias("score"),
    )
