"""Toxic spans by a linear-chain conditional random field, summed up to a document score.

Null and empty texts have no tokens and get the score of a text without any toxic token. Labels that are
null teach nothing; without examples of both labels every score is the share of label 1 (zero
without any). Repeated texts teach once. Very long texts are tagged as one chain. Only doc_id and
text of the documents are read.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import documents_only, lists, slices

#: Labelled documents of each class that the model is fitted on, at most, picked by hash.
SAMPLE = {0: 4000, 1: 2500}
#: Bytes of their texts of each class, at most; in the order of the hash, a text that does not fit is passed over.
SAMPLE_BYTES = 24_000_000
#: Rows of the hashed weight table.
WEIGHTS = 1 << 18
#: A cue must be this many times likelier in toxic texts and explain this many texts that no other cue does.
PURITY, LEAST_TEXTS = 25.0, 3
EPOCHS, RATE, L2 = 60, 0.5, 1e-4
#: Tokens whose gradient is worked out together while fitting, but for a longer text.
GROUP_TOKENS = 600_000
_CACHE = 400_000
_NOT_LETTER = re.compile(r"[\W\d_]+")

RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
])


def word(token: str) -> str:
    return _NOT_LETTER.sub("", token.lower())


def cues(name: str) -> list[str]:
    """What a word may be recognised by: itself, and its first letters."""
    return [f"w {name}", *[f"p {name[:n]}" for n in (4, 5, 6) if len(name) > n]] if name else []


def features(name: str) -> list[int]:
    """Rows of the weight table for a word: the word, its beginnings and endings."""
    from zlib import crc32
    named = [*cues(name), *[f"s {name[-n:]}" for n in (3, 4) if len(name) > n]]
    return [crc32(f.encode()) % WEIGHTS for f in named] + [WEIGHTS] * (6 - len(named))


def toxic_cues(texts: list, labels: np.ndarray) -> set[str]:
    """Cues that tell toxic texts, given as their words: among pure ones, always the one that explains most texts still unexplained."""
    counts = (Counter(), Counter())
    for i in np.flatnonzero(labels):
        counts[1].update({c for name in set(texts[i]) for c in cues(name)})
    able = {cue for cue, n in counts[1].items() if n >= LEAST_TEXTS}
    for i in np.flatnonzero(1 - labels):
        counts[0].update({c for name in set(texts[i]) for c in cues(name) if c in able})
    n_toxic, n_clean = int(labels.sum()), int((1 - labels).sum())
    pure: dict[str, set[int]] = {
        cue: set() for cue, n in counts[1].items()
        if cue in able and (n + 0.5) / (n_toxic + 1) >= PURITY * (counts[0][cue] + 0.5) / (n_clean + 1)}
    for i in np.flatnonzero(labels):
        for cue in {c for name in set(texts[i]) for c in cues(name)}:
            if cue in pure:
                pure[cue].add(int(i))
    chosen: set[str] = set()
    left = set().union(*pure.values()) if pure else set()
    heap = [(-len(held), -len(cue), cue) for cue, held in pure.items()]
    heapq.heapify(heap)
    while heap:  # gains only shrink, so a cue whose gain still holds is the best
        gain, size, cue = heapq.heappop(heap)
        now = len(pure[cue] & left)
        if now < LEAST_TEXTS:
            continue
        if now < -gain:
            heapq.heappush(heap, (-now, size, cue))
            continue
        chosen.add(cue)
        left -= pure[cue]
    return chosen


def messages(score: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
             move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponential scores and forward and backward messages at every token of many chains.

    With two tags a message is one ratio, toxic to clean, so a step handles all chains that are long enough at
    once; ``score`` is the toxic tag's advantage at each token and ``move`` the exponential transition table.
    """
    order = np.argsort(-lengths, kind="stable")
    begin, size = starts[order], lengths[order]
    push = np.exp(np.clip(score, -30, 30))
    ahead, back = np.empty_like(push), np.empty_like(push)
    alive = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    for t, k in enumerate(alive):
        at = begin[:k] + t
        ahead[at] = push[at] if t == 0 else push[at] * (move[0, 1] + move[1, 1] * before[:k]) / (
            move[0, 0] + move[1, 0] * before[:k])
        before = ahead[at]
    for t, k in enumerate(alive):
        at = begin[:k] + size[:k] - 1 - t
        if t == 0:
            message = np.ones(k)
        else:
            weight = push[at + 1] * message[:k]
            message = (move[1, 0] + move[1, 1] * weight) / (move[0, 0] + move[0, 1] * weight)
        back[at] = message
    return push, ahead, back


def marginal_odds(score: np.ndarray, starts: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Forward-backward odds of the toxic tag at every token."""
    _, ahead, back = messages(score, starts, lengths, move)
    return ahead * back


def with_edges(score: np.ndarray, starts: np.ndarray, lengths: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Scores with the weights of a toxic first and a toxic last token added, for chains that have tokens."""
    score = score.copy()
    score[starts[lengths > 0]] += edges[0]
    score[(starts + lengths - 1)[lengths > 0]] += edges[1]
    return score


def slopes(score: np.ndarray, gold: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
           move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the chains' log-likelihood: by the score of each token, and by the log transitions.

    Each is what the tags ``gold`` hold less what the field expects, token by token and pair by pair.
    """
    push, ahead, back = messages(score, starts, lengths, move)
    odds = ahead * back
    inner = np.ones(len(score), bool)
    inner[starts[lengths > 0]] = False
    after = np.flatnonzero(inner)
    come, go = ahead[after - 1], push[after] * back[after]
    pairs = [[move[0, 0] * np.ones(len(after)), move[0, 1] * go], [move[1, 0] * come, move[1, 1] * come * go]]
    whole = sum(map(sum, pairs))
    expected = np.array([[(one / whole).sum() for one in row] for row in pairs])
    held = np.bincount(2 * gold[after - 1].astype(int) + gold[after].astype(int), minlength=4).reshape(2, 2)
    return gold - odds / (1 + odds), held - expected


class Tagger:
    """The fitted field: weights, transitions, edges, and how marginals make a document score."""

    def __init__(self, weights: np.ndarray, move: np.ndarray, edges: np.ndarray, blend: np.ndarray):
        self.weights, self.move, self.edges, self.blend = weights, move, edges, blend
        self.known: dict[str, float] = {}

    def push(self, token: str) -> float:
        if len(self.known) > _CACHE:
            self.known.clear()
        value = float(self.weights[features(word(token))].sum() + self.weights[WEIGHTS + 1])
        if len(token) <= 64:
            self.known[token] = value
        return value

    def tag(self, texts: list[str | None]) -> list[np.ndarray]:
        """Probability of the toxic tag for every white-space token of every text."""
        chains = []
        for text in texts:
            tokens = (text or "").split()
            got = self.known.get
            chains.append(np.array([p if (p := got(token)) is not None else self.push(token) for token in tokens]))
        lengths = np.array([len(c) for c in chains], np.int64)
        starts = np.cumsum(lengths) - lengths
        score = with_edges(np.concatenate(chains) if len(chains) else np.empty(0), starts, lengths, self.edges)
        odds = marginal_odds(score, starts, lengths, np.exp(self.move))
        share = odds / (1 + odds)
        return [share[a:a + n] for a, n in zip(starts, lengths)]

    def score(self, marginals: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(summary(marginals) @ self.blend, -50, 50))))


def summary(marginals: np.ndarray) -> np.ndarray:
    """What a document score is made of: one, the highest marginal, and the marginals of the tokens tagged toxic.

    Tokens below one half are left out of the sum, so that a text is not toxic for being long.
    """
    return np.array([1.0, marginals.max() if len(marginals) else 0.0, np.log1p(marginals[marginals >= 0.5].sum())])


def fit_field(texts: list[str], labels: np.ndarray, prevalence: float) -> Tagger:
    """Fit on labelled texts: tag tokens by cues, then gradient steps on the chain likelihood, in
    which word weights, transitions and edges all take part."""
    one: dict[str, str] = {}  # equal words are one object, however often they occur
    tokens = [[one.setdefault(name, name) for name in map(word, text.split())] for text in texts]
    found = toxic_cues(tokens, labels)
    number: dict[str, int] = {}
    chains = [np.array([number.setdefault(name, len(number)) for name in names], np.int32) for names in tokens]
    del tokens, one
    table = np.fromiter((f for name in number for f in features(name)), np.int32).reshape(-1, 6)
    hit = np.array([any(cue in found for cue in cues(name)) for name in number], bool)
    used = sorted((i for i, chain in enumerate(chains) if len(chain)), key=lambda i: len(chains[i]))
    groups, at = [], 0  # chains of similar length together, so that a step works on few tokens at a time
    while at < len(used):
        size = int(np.searchsorted(np.cumsum([len(chains[i]) for i in used[at:]]), GROUP_TOKENS, side="right"))
        picked = used[at:at + max(size, 1)]
        lengths = np.array([len(chains[i]) for i in picked], np.int64)
        flat = np.concatenate([chains[i] for i in picked])
        groups.append((flat, hit[flat] & (np.repeat(labels[picked], lengths) == 1), np.cumsum(lengths) - lengths, lengths))
        at += len(picked)
    del chains
    weights, grown = np.zeros(WEIGHTS + 2), np.full(WEIGHTS + 2, 1e-6)
    chain, chain_grown = np.zeros(6), np.full(6, 1e-6)  # four transitions, two edges
    for _ in range(EPOCHS):
        per_word = weights[table].sum(axis=1) + weights[WEIGHTS + 1]
        miss, moved, edge = np.zeros(len(number)), np.zeros((2, 2)), np.zeros(2)
        for flat, gold, starts, lengths in groups:
            score = with_edges(per_word[flat], starts, lengths, chain[4:])
            miss_at, pairs = slopes(score, gold, starts, lengths, np.exp(chain[:4].reshape(2, 2)))
            miss += np.bincount(flat, miss_at, len(number))
            moved += pairs
            edge += [miss_at[starts].sum(), miss_at[starts + lengths - 1].sum()]
        step = np.bincount(table.ravel(), np.repeat(miss, table.shape[1]), WEIGHTS + 2) / max(len(used), 1)
        step[WEIGHTS + 1] = miss.sum() / max(len(used), 1)
        step[WEIGHTS] = 0
        step -= L2 * weights
        grown += step ** 2
        weights += RATE * step / np.sqrt(grown)
        weights[WEIGHTS] = 0
        step = np.concatenate([moved.ravel(), edge]) / max(len(used), 1) - L2 * chain
        chain_grown += step ** 2
        chain += RATE * step / np.sqrt(chain_grown)
    tagger = Tagger(weights, chain[:4].reshape(2, 2), chain[4:], np.zeros(3))
    at = np.array([summary(m) for i in range(0, len(texts), 200) for m in tagger.tag(texts[i:i + 200])])
    share = labels.mean()
    weight = np.where(labels == 1, prevalence / share, (1 - prevalence) / (1 - share))
    blend = np.zeros(3)
    for _ in range(400):
        guess = 1 / (1 + np.exp(-np.clip(at @ blend, -50, 50)))
        slope = at.T @ (weight * (labels - guess)) / weight.sum() - 1e-4 * blend * [0, 1, 1]
        curve = (at * (weight * guess * (1 - guess))[:, None]).T @ at / weight.sum() + 1e-4 * np.eye(3)
        blend += np.linalg.solve(curve, slope) * 0.5
    tagger.blend = blend
    tagger.known.clear()
    return tagger


def learn_tagger(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> Tagger | float:
    """A tagger from ``labels(doc_id, label)``, or the share of label 1 if a class has no example.

    The share is counted over all labels; the field is fitted on at most ``sample`` documents and ``SAMPLE_BYTES``
    of text a class, different texts, picked by hash. Of rows that repeat a doc_id the one of the shortest text
    teaches, so a doc_id that fills much of the table reaches the driver once.
    """
    sample = sample or SAMPLE
    known = labels.where("label IN (0, 1)").select(F.col("doc_id").cast("long"), F.col("label").cast("int"))
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    prevalence = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return prevalence
    hashed = known.distinct().withColumn("pick", F.xxhash64("doc_id", F.lit("toxicity")))
    tops = [hashed.where(F.col("label") == label).orderBy("pick").limit(most) for label, most in sample.items()]
    picked = reduce(DataFrame.unionByName, tops)
    held = documents_only(docs).where("text IS NOT NULL").withColumn("code", F.xxhash64("text"))
    sizes = held.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label", "pick").agg(
        F.min(F.struct(F.octet_length("text").alias("size"), "code")).alias("least")).select("doc_id", "label", "pick", "least.*")
    chosen, taken = [], {0: 0, 1: 0}
    for row in sorted(sizes.collect(), key=lambda r: (r["pick"], r["doc_id"], r["label"])):
        if taken[row["label"]] + row["size"] <= SAMPLE_BYTES:
            taken[row["label"]] += row["size"]
            chosen.append((row["doc_id"], row["code"], row["label"]))
    wanted = docs.sparkSession.createDataFrame(chosen, "doc_id long, code long, label int")
    rows = held.join(F.broadcast(wanted), ["doc_id", "code"]).dropDuplicates(["doc_id", "label"]).select("text", "label")
    different: dict[str, int] = {}
    for row in rows.collect():
        different[row["text"]] = max(row["label"], different.get(row["text"], 0))
    values = np.array(list(different.values()), np.int64)
    if not len(values) or values.min() == values.max():
        return prevalence
    texts = sorted(different)
    return fit_field(texts, np.array([different[t] for t in texts], np.int64), prevalence)


def score_toxicity(docs: DataFrame, model: Tagger | float) -> DataFrame:
    """``(doc_id, score, spans)``: spans are character offsets of tokens more likely toxic than not."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        tagger = shared.value
        for batch in batches:
            for part in slices(batch, limit=16_000_000):
                texts = part.column("text").to_pylist()
                if isinstance(tagger, float):
                    scores, spans = [tagger] * len(texts), [[] for _ in texts]
                else:
                    marginals = tagger.tag(texts)
                    scores = [tagger.score(m) for m in marginals]
                    spans = [toxic_spans(text, m) for text, m in zip(texts, marginals)]
                flat = [span for one in spans for span in one]
                pairs = pa.StructArray.from_arrays(
                    [pa.array([s for s, _ in flat], pa.int32()), pa.array([e for _, e in flat], pa.int32())], ["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores, pa.float64()), lists(np.cumsum([0, *map(len, spans)]), pairs)],
                    RESULT.names)

    return documents_only(docs).mapInArrow(run, RESULT)


def toxic_spans(text: str | None, marginals: np.ndarray) -> list[tuple[int, int]]:
    if not (marginals >= 0.5).any():
        return []
    return [m.span() for m, p in zip(re.finditer(r"\S+", text), marginals) if p >= 0.5]
