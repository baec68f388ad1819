"""Secrets in whole texts: fixed patterns, and a character convolutional network over further candidates."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.known_findings import known_findings
from namewright.sources.staging import stage

#: Kinds in the order of equal starts; patterns and shortest lengths are fixed values.
KINDS = ("assign", "access", "hex", "learned")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LENGTH = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

#: Candidates of the network: runs of key characters as long as an assigned secret, other than a single word or number and the marks around it.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
SINGLE = re.compile(r"[+/_.=-]*(?:[A-Z]?[a-z]*|[A-Z]+|[0-9]+)[+/_.=-]*")

#: Candidates that count as no secret unless labelled otherwise: words, hosts, paths, numbers and UUIDs. A word is of one case, a capital first
#: or several such (camel case), and may end in a number.
_BETWEEN = re.compile(r"[+/_.=-]+")
_PLAIN = re.compile(r"[0-9]{1,14}|(?:[a-z]{1,20}|[A-Z]{1,20}|[a-z]{0,20}(?:[A-Z][a-z]{2,19}){1,6})[0-9]{0,4}")
_UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}")

CONTEXT = 24
#: Characters of a window that the network sees at once; longer ones are seen in overlapping pieces.
PIECE, OVERLAP = 112, 48

FOUND_SCHEMA = (
    "_id long, found array<struct<kind: string, start: long, end: long, low: long, high: long, before: string, body: string, after: string, clean: boolean>>"
)


@dataclass(frozen=True)
class Training:
    #: Labelled findings of each class at most, besides the known ones; by default all are fitted on.
    findings: int | None = None
    #: Generated findings of each class (``known_findings``) that the network is always fitted on.
    known: int = 5000
    #: Fewer findings of a class than this: no network, base patterns alone.
    least: int = 30
    #: Share of the held-out secrets that must stay above the threshold.
    recall: float = 0.98
    #: Candidates below this calibrated probability are never added.
    floor: float = 0.5
    epochs: int = 10
    #: Findings that a task fits on at once: the bound of what one holds. The networks of all blocks are averaged after each epoch.
    block: int = 20_000
    seed: int = 11


def base_spans(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, end, kind, start and end of the secret itself) by start, then kind as listed."""
    spans = [
        (m.start(), m.end(), "assign", m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH
    ]
    spans += [(m.start(), m.end(), "access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> list[tuple[int, int, str, int, int]]:
    """The base spans, then the candidates of the network that overlap none of them."""
    spans = base_spans(text)
    taken = sorted(span[:2] for span in spans)
    place, reach = 0, -1
    for m in CANDIDATE.finditer(text):
        if SINGLE.fullmatch(m[0]):
            continue
        while place < len(taken) and taken[place][0] < m.end():
            reach = max(reach, taken[place][1])
            place += 1
        if reach <= m.start():
            spans.append((m.start(), m.end(), "learned", m.start(), m.end()))
    return spans


def looks_clean(body: str) -> bool:
    """Whether a candidate is made of words and numbers; one that looks random may be a secret without a label."""
    return _UUID.fullmatch(body) is not None or all(_PLAIN.fullmatch(part) for part in _BETWEEN.split(body) if part)


def _labels(found: DataFrame) -> DataFrame:
    """The base findings as secrets, candidates that look clean as none; the others have no label."""
    entries = found.select(F.inline("found")).where("kind != 'learned' OR clean")
    return entries.select("before", "body", "after", (F.col("kind") != "learned").alias("secret"))


def surroundings(text: str, low: int, high: int) -> tuple[str, str, str]:
    return text[max(low - CONTEXT, 0) : low], text[low:high], text[high : high + CONTEXT]


def find_candidates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: all base spans and further candidates, each with the characters around it."""
    return documents.select(
        F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text")
    ).mapInArrow(_find, FOUND_SCHEMA)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    entry = pa.struct([("kind", pa.string()), *((c, pa.int64()) for c in ("start", "end", "low", "high")), *((c, pa.string()) for c in ("before", "body", "after")), ("clean", pa.bool_())])
    for batch in batches:
        found = []
        for value in batch.column("_text"):
            text = value.as_py() or ""
            found.append([
                dict(zip(entry.names, (kind, start, end, low, high, *surroundings(text, low, high), kind == "learned" and looks_clean(text[low:high])), strict=True))
                for start, end, kind, low, high in candidates(text)
            ])
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found, pa.list_(entry))], names=["_id", "found"])


def secret_scan(
    documents: DataFrame,
    labelled: DataFrame | None = None,
    training: Training = Training(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Secrets of whole texts; one row per input row: (id, findings, n_scored), findings being an array of (kind, start, end, score).

    Places are code points, the end exclusive, in the order of the start, then of KINDS. The base patterns always count. Every other
    candidate, a run of 8 or more key characters that overlaps no base span and is no single word or number, is scored with its surroundings by a small
    character convolutional network and added, as kind "learned", if its calibrated probability reaches the threshold.

    ``labelled`` has findings (before, body, after, secret boolean). By default they come from the documents themselves: the base findings are the
    secrets, candidates that look clean (words, hosts, paths, numbers, UUIDs) the rest; others have no label and are only scored. To them come
    the generated findings of ``known_findings``, which the patterns have no part in; so there is a network for every table, and it knows keys that no
    pattern matches. All distinct findings of ``labelled`` are fitted on, in blocks side by side, see ``learn``; both classes weigh alike, however many findings they have.
    With ``training.findings`` at most so many of each class are, the lowest by hash, one of each body before further ones of a body. Half of the secrets are shown without the words before them, so that the key itself counts. A fifth of the bodies is held out: it
    calibrates the scores (logistic), and the threshold is the highest that keeps the wanted share of its secrets. ``n_scored`` counts the candidates
    that the network has judged.

    Two passes over documents in parallel; only hashes of findings are shuffled: candidates are written once, then scored. Long candidates are seen in overlapping pieces,
    the highest score counts. Null text is empty and has no findings; repeated rows are scanned alike; a null id stays null.
    """
    found = stage(find_candidates(documents, id_column, text_column), "secret-candidates")
    if labelled is None:
        labelled = _labels(found)
    network = learn(labelled, training)
    findings = "array<struct<kind: string, start: long, end: long, score: double>>"
    return found.mapInArrow(lambda batches: _score(batches, network), f"_id long, findings {findings}, n_scored long").select(
        F.col("_id").alias(id_column), "findings", "n_scored"
    )


def _chosen(labelled: DataFrame, training: Training) -> DataFrame:
    """Distinct findings with whole bodies: all, or as many as are wanted of each class, as many bodies as there are first; only hashes are shuffled to choose them."""
    if training.findings is None:
        return labelled.select("before", "body", "after", "secret").where(F.col("secret").isNotNull()).distinct()
    keyed = labelled.withColumns({"_hash": F.xxhash64("before", "body", "after"), "_of": F.xxhash64("body")})
    chosen = []
    for secret in (True, False):
        part = keyed.where(F.col("secret") == secret)
        bodies = part.groupBy("_of").agg(F.min("_hash").alias("_hash")).orderBy("_of").limit(training.findings)
        hashes = {r["_hash"]: None for r in bodies.collect()}
        if len(hashes) < training.findings:
            more = part.select("_hash").distinct().orderBy("_hash").limit(training.findings)
            hashes |= {r["_hash"]: None for r in more.collect()}
        chosen += [(code, secret) for code in list(hashes)[: training.findings]]
    wanted = labelled.sparkSession.createDataFrame(chosen, "_hash long, secret boolean")
    return keyed.join(F.broadcast(wanted), ["_hash", "secret"]).select("before", "body", "after", "secret").distinct()


def learn(labelled: DataFrame, training: Training) -> Network:
    """A network fitted on the known findings and all labelled ones, or as many as ``training`` wants.

    Findings are dealt by hash to blocks of about ``training.block``. In each epoch every block goes on from the same network, in a task of its own, and
    the networks and moments that come out are averaged, weighted by findings, as Spark's Word2Vec does with its parts; up to one block that is plain training.
    Calibration adds sums over all held-out findings, and the threshold is an exact order statistic of all of them. The driver holds one network and
    the lowest scores up to the threshold; bodies of any length stay in tasks.
    """
    known = labelled.sparkSession.createDataFrame(known_findings(training.known), "before string, body string, after string, secret boolean")
    sample = stage(_chosen(labelled, training).union(known).distinct(), "secret-sample")
    pieces = stage(sample.mapInArrow(_pieces, "text string, low int, high int, secret boolean, held boolean, code long"), "secret-pieces")
    counts = {(r["secret"], r["held"]): r["count"] for r in pieces.groupBy("secret", "held").count().collect()}
    if not _enough(counts, training):
        raise ValueError("too few known findings to fit a network on")
    shown = pieces.where("NOT held").drop("held")
    blocks = max(1, -(-(counts[True, False] + counts[False, False]) // training.block))
    fitting = _Fitting(training, *_weights(counts[False, False], counts[True, False]))
    for epoch in range(training.epochs):
        _epoch(shown, fitting, blocks, epoch)
    return _settled(sample, fitting.network, _weights(counts[False, True], counts[True, True]), training)


def _epoch(shown: DataFrame, fitting: _Fitting, blocks: int, epoch: int) -> None:
    """One epoch over all blocks."""

    def fit_block(key: tuple, rows: pa.Table) -> pa.Table:
        block = key[0].as_py()
        rows = rows.sort_by([(name, "ascending") for name in ("secret", "text", "low", "high")])
        arrays = as_arrays(list(zip(*(rows[name].to_pylist() for name in ("text", "low", "high")), strict=True)))
        own = fitting.copy()
        own.epoch(*arrays, np.array(rows["secret"].to_pylist(), dtype=np.float32), (block, epoch))
        return pa.table({"n": pa.array([len(rows)]), "step": pa.array([own.step]), "state": pa.array([own.state().tolist()], pa.list_(pa.float64()))})

    dealt = shown.withColumn("block", F.pmod("code", F.lit(blocks))).groupBy("block")
    states = stage(dealt.applyInArrow(fit_block, "n long, step long, state array<double>"), "secret-networks")
    total, step = states.agg(F.sum("n"), F.max("step")).first()
    # In one order, so that sums are the same in every run.
    parts = F.sort_array(F.collect_list(F.col("value") * F.col("n")))
    means = states.select("n", F.posexplode("state").alias("place", "value")).groupBy("place").agg(
        (F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / total).alias("mean")
    )
    fitting.load(np.array([r["mean"] for r in means.orderBy("place").collect()]), step)


def _settled(sample: DataFrame, network: Network, weights: tuple[float, float], training: Training) -> Network:
    """Calibrate on all held-out findings and set the threshold."""
    scores = stage(sample.mapInArrow(lambda batches: _raw_of_held(batches, network), "raw double, secret boolean"), "secret-scores")

    def sums(slope: float, offset: float) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _sums(*_scored(batch, weights), slope, offset)
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found.tolist()], names=list("abcdef"))

        return np.sum(sorted(tuple(r) for r in scores.mapInArrow(run, "a double, b double, c double, d double, e double, f double").collect()), axis=0)

    _calibrate(network, sums)
    secrets = scores.where("secret")
    skipped = int((1 - training.recall) * secrets.count())
    lowest = secrets.orderBy("raw").offset(skipped).limit(1).first()
    network.threshold = max(_probability(network, lowest["raw"]) if lowest else 1.0, training.floor)
    reached = 1 / (1 + F.exp(-(network.slope * F.col("raw") + network.offset))) >= network.threshold - 1e-12
    found = scores.where(reached).agg(F.count_if("secret").alias("secrets"), F.count("*").alias("n")).first()
    network.recall, network.precision = found["secrets"] / max(secrets.count(), 1), found["secrets"] / max(found["n"], 1)
    return network


def _scored(batch: pa.RecordBatch, weights: tuple[float, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Raw scores, classes and weights of held-out findings."""
    secret = np.array(batch.column("secret").to_pylist(), dtype=bool)
    return batch.column("raw").to_numpy(), secret.astype(np.float32), np.where(secret, weights[1], weights[0])


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[str, str, str, bool]]:
    for entry in zip(*(batch.column(c) for c in ("before", "body", "after", "secret")), strict=True):
        yield tuple(value.as_py() for value in entry)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"text": pa.string(), "low": pa.int32(), "high": pa.int32(), "secret": pa.bool_(), "held": pa.bool_(), "code": pa.int64()}
    for batch in batches:
        rows = [(*_piece(*_shown(*entry)), entry[3], _held(entry[1]), zlib.crc32("\n".join(entry[:3]).encode("utf-8", "surrogatepass"))) for entry in _entries(batch)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types.values())], names=list(types))


def _raw_of_held(batches: Iterator[pa.RecordBatch], network: Network) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [entry for entry in _entries(batch) if _held(entry[1])]
        raw = network.raw([_shown(*entry) for entry in held]).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(raw, pa.float64()), pa.array([e[3] for e in held], pa.bool_())], names=["raw", "secret"])


def _score(batches: Iterator[pa.RecordBatch], network: Network) -> Iterator[pa.RecordBatch]:
    entry = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    for batch in batches:
        rows = batch.column("found").to_pylist()
        every = [(f["before"], f["body"], f["after"]) for row in rows for f in row]
        scores = iter(network.probability(every))
        out, n_scored = [], []
        for row in rows:
            scored = [(f["kind"], f["start"], f["end"], score) for f, score in zip(row, scores, strict=False)] if row else []
            kept = [s for s in scored if s[0] != "learned" or s[3] >= network.threshold]
            n_scored.append(sum(s[0] == "learned" for s in scored))
            kept.sort(key=lambda s: (s[1], KINDS.index(s[0])))
            out.append([dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in kept])
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(out, pa.list_(entry)), pa.array(n_scored, pa.int64())], names=["_id", "findings", "n_scored"]
        )


# The network

#: Input ids: ASCII, any other character, padding.
OTHER, PADDING = 128, 129
EMBEDDING, WIDTH, FILTERS = 8, 5, 24


class Network:
    """Characters -> embedding and a mark for the candidate -> convolution -> largest and mean -> probability."""

    def __init__(self, seed: int) -> None:
        draw = np.random.default_rng(seed)
        self.embed = draw.normal(0, 0.3, (PADDING + 1, EMBEDDING)).astype(np.float32)
        self.filters = draw.normal(0, 0.2, (WIDTH * (EMBEDDING + 1), FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.out = draw.normal(0, 0.2, 2 * FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)
        #: Calibration of the raw score, and the threshold on the calibrated probability.
        self.slope, self.offset, self.threshold = 1.0, 0.0, 0.5
        #: Shares on the held-out findings: of secrets found, and of findings that are secrets.
        self.recall, self.precision = 0.0, 0.0

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shift, self.out, self.bias]

    def forward(self, ids: np.ndarray, inside: np.ndarray):
        seen = np.concatenate([self.embed[ids], inside[:, :, None]], axis=2)
        windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH, axis=1).transpose(0, 1, 3, 2)
        windows = windows.reshape(len(ids), -1, WIDTH * (EMBEDDING + 1))
        active = np.maximum(windows @ self.filters + self.shift, 0)
        best = active.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(active, best[:, None, :], 1)[:, 0], active.mean(axis=1)], axis=1)
        return pooled @ self.out + self.bias, (windows, active, best, pooled)

    def gradients(self, ids: np.ndarray, inside: np.ndarray, target: np.ndarray, weight: np.ndarray | float = 1.0) -> list[np.ndarray]:
        raw, (windows, active, best, pooled) = self.forward(ids, inside)
        error = (weight * (1 / (1 + np.exp(-raw)) - target) / len(target)).astype(np.float32)
        back = error[:, None] * self.out
        wave = np.repeat(back[:, None, FILTERS:] / active.shape[1], active.shape[1], axis=1)
        rows = np.arange(len(ids))[:, None]
        wave[rows, best, np.arange(FILTERS)] += back[:, :FILTERS]
        wave *= active > 0
        # A small product per finding: none is worth the threads of a large one.
        filters = np.matmul(windows.transpose(0, 2, 1), wave).sum(axis=0)
        spread = (wave @ self.filters.T).reshape(len(ids), -1, WIDTH, EMBEDDING + 1)[..., :EMBEDDING]
        seen = np.zeros((*ids.shape, EMBEDDING), dtype=np.float32)
        for step in range(WIDTH):
            seen[:, step : step + spread.shape[1]] += spread[:, :, step]
        flat_ids = ids.ravel()
        embed = np.stack([np.bincount(flat_ids, seen[:, :, d].ravel(), len(self.embed)) for d in range(EMBEDDING)], axis=1).astype(np.float32)
        return [embed, filters, wave.sum(axis=(0, 1)), pooled.T @ error, error.sum(keepdims=True)]

    def raw(self, findings: list[tuple[str, str, str]], batch: int = 512) -> np.ndarray:
        """Raw score of each finding, the highest of its pieces."""
        pieces, owner = [], []
        for at, (before, body, after) in enumerate(findings):
            for piece in cut(before, body, after):
                pieces.append(piece)
                owner.append(at)
        out = np.full(len(findings), -np.inf)
        for start in range(0, len(pieces), batch):
            raw, _ = self.forward(*as_arrays(pieces[start : start + batch]))
            np.maximum.at(out, owner[start : start + batch], raw)
        return out

    def probability(self, findings: list[tuple[str, str, str]]) -> list[float]:
        if not findings:
            return []
        return (1 / (1 + np.exp(-np.clip(self.slope * self.raw(findings) + self.offset, -60, 60)))).tolist()


def cut(before: str, body: str, after: str) -> Iterator[tuple[str, int, int]]:
    """(characters, start and end of the candidate there) of at most PIECE characters."""
    text, low, high = f"{before}{body}{after}", len(before), len(before) + len(body)
    at = 0
    while True:
        end = min(at + PIECE, len(text))
        yield text[at:end], max(low - at, 0), max(min(high - at, end - at), 0)
        if end == len(text):
            return
        at = end - OVERLAP


def as_arrays(pieces: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.full((len(pieces), PIECE), PADDING, dtype=np.int64)
    inside = np.zeros((len(pieces), PIECE), dtype=np.float32)
    for row, (text, low, high) in enumerate(pieces):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ids[row, : len(codes)] = np.minimum(codes, OTHER)
        inside[row, low:high] = 1
    return ids, inside


def _held(body: str) -> bool:
    """Whether a body, in all its findings, is held out: a fifth are."""
    return zlib.crc32(body.encode("utf-8", "surrogatepass")) % 5 == 0


def _shown(before: str, body: str, after: str, secret: bool) -> tuple[str, str, str]:
    """A finding as the network is shown it: half of the secrets without the words before them."""
    bare = secret and zlib.crc32(f"{before}\n{body}\n{after}".encode("utf-8", "surrogatepass")) & 1
    return "" if bare else before, body, after


def _piece(before: str, body: str, after: str) -> tuple[str, int, int]:
    """One of the pieces of a finding, by hash: the beginning, the middle and the end of long ones are all trained on."""
    pieces = list(cut(before, body, after))
    return pieces[zlib.crc32(body.encode("utf-8", "surrogatepass")) // 5 % len(pieces)]


def fit(findings: list[tuple[str, str, str, bool]], training: Training) -> Network | None:
    """Fit by Adam on a piece of each finding of four fifths of the bodies, calibrate and set the threshold on the whole findings of the rest.

    No network with too few findings of a class, or with a class missing on a side.
    """
    shown, classes = [_shown(*f) for f in findings], [secret for *_, secret in findings]
    apart = [_held(body) for _, body, *_ in findings]
    network = _train([_piece(*f) for f in shown], classes, apart, training)
    if network is None:
        return None
    held = np.flatnonzero(apart)
    return _settle(network, network.raw([shown[i] for i in held]), np.array(classes, dtype=np.float32)[held], training)


def _enough(counts: dict[tuple[bool, bool], int], training: Training) -> bool:
    """Whether there are enough findings, counted by class and side, of each class, and both classes on both sides."""
    whole = [sum(n for (secret, _), n in counts.items() if secret == wanted) for wanted in (True, False)]
    return min(whole) >= training.least and len(counts) == 4


def _weights(clean: int, secrets: int) -> tuple[float, float]:
    """What a finding of each class weighs, so that both classes weigh alike and findings 1 on average."""
    return (clean + secrets) / (2 * clean), (clean + secrets) / (2 * secrets)


class _Fitting:
    """A network that is being fitted by Adam: its parameters, their moments and the steps done."""

    def __init__(self, training: Training, clean: float, secret: float) -> None:
        self.training, self.clean, self.secret = training, clean, secret
        self.network, self.step = Network(training.seed), 0
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.network.parameters()]

    def _arrays(self) -> list[np.ndarray]:
        return [*self.network.parameters(), *(moment for pair in self.moments for moment in pair)]

    def state(self) -> np.ndarray:
        return np.concatenate([array.ravel() for array in self._arrays()]).astype(np.float64)

    def load(self, state: np.ndarray, step: int) -> None:
        at, self.step = 0, step
        for array in self._arrays():
            array[...] = state[at : at + array.size].reshape(array.shape)
            at += array.size

    def copy(self) -> _Fitting:
        other = _Fitting(self.training, self.clean, self.secret)
        other.load(self.state(), self.step)
        return other

    def epoch(self, ids: np.ndarray, inside: np.ndarray, target: np.ndarray, draw: tuple[int, int]) -> None:
        """Each finding once, in an order that ``draw`` decides."""
        order = np.random.default_rng((self.training.seed, *draw)).permutation(len(target))
        weight = np.where(target == 1, self.secret, self.clean).astype(np.float32)
        for start in range(0, len(order), 64):
            batch = order[start : start + 64]
            self.step += 1
            gradients = self.network.gradients(ids[batch], inside[batch], target[batch], weight[batch])
            for p, g, (m, v) in zip(self.network.parameters(), gradients, self.moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.005 * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def _train(pieces: list[tuple[str, int, int]], classes: list[bool], apart: list[bool], training: Training) -> Network | None:
    counts = Counter(zip(classes, apart, strict=True))
    if not _enough(counts, training):
        return None
    used = np.flatnonzero(~np.array(apart))
    fitting = _Fitting(training, *_weights(counts[False, False], counts[True, False]))
    ids, inside = as_arrays([pieces[i] for i in used])
    target = np.array(classes, dtype=np.float32)[used]
    for epoch in range(training.epochs):
        fitting.epoch(ids, inside, target, (0, epoch))
    return fitting.network


def _probability(network: Network, raw: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(network.slope * raw + network.offset, -60, 60))))


def _settle(network: Network, raw: np.ndarray, target: np.ndarray, training: Training) -> Network:
    """Calibrate on held-out findings and set the threshold."""
    clean, secret = _weights(int((target == 0).sum()), int((target == 1).sum()))
    weight = np.where(target == 1, secret, clean)
    _calibrate(network, lambda slope, offset: _sums(raw, target, weight, slope, offset))
    secrets = np.sort(raw[target == 1])
    network.threshold = max(_probability(network, secrets[int((1 - training.recall) * len(secrets))]), training.floor)
    above = 1 / (1 + np.exp(-(network.slope * raw + network.offset))) >= network.threshold
    found = float((above & (target == 1)).sum())
    network.recall, network.precision = found / max((target == 1).sum(), 1), found / max(above.sum(), 1)
    return network


def _sums(raw: np.ndarray, target: np.ndarray, weight: np.ndarray, slope: float, offset: float) -> np.ndarray:
    """The weighted logistic loss at a slope and an offset, its gradient (2) and curvature (3)."""
    z = slope * np.asarray(raw, dtype=np.float64) + offset
    p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    w, off = weight * (p * (1 - p) + 1e-9), weight * (p - target)
    loss = (weight * (np.logaddexp(0, z) - target * z)).sum()
    return np.array([loss, (off * raw).sum(), off.sum(), (w * raw * raw).sum(), (w * raw).sum(), w.sum()])


def _calibrate(network: Network, sums: Callable[[float, float], np.ndarray]) -> None:
    """Logistic fit of the held-out labels to the raw scores by Newton's steps, halved where they go too far; a little weight on the slope keeps it finite."""

    def at(place: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, by_slope, by_offset, twice, mixed, whole = sums(*place.tolist())
        away = place - (1, 0)
        return loss + 0.05 * (away**2).sum(), np.array([by_slope, by_offset]) + 0.1 * away, np.array([[twice + 0.1, mixed], [mixed, whole + 0.1]])

    place = np.array([1.0, 0.0])
    loss, gradient, curve = at(place)
    move = np.linalg.solve(curve, gradient)
    for _ in range(50):
        there = at(place - move)
        if there[0] > loss:
            move = move / 2
        else:
            place = place - move
            loss, gradient, curve = there
            move = np.linalg.solve(curve, gradient)
        if np.abs(move).max() < 1e-6:
            break
    network.slope, network.offset = map(float, place)


def redact_secrets(
    documents: DataFrame, training: Training = Training(), id_column: str = "doc_id", text_column: str = "text", mask: str = "<secret>"
) -> DataFrame:
    """The documents, all columns, with ``mask`` in place of every secret that ``secret_scan`` reports.

    The network is fitted as there; the texts are then scanned and rewritten where they lie, without a join. Overlapping spans are replaced once.
    Of an assignment the value is replaced and the name stays. Texts without secrets, and null texts, are unchanged.
    """
    found = stage(find_candidates(documents, id_column, text_column), "secret-candidates")
    network = learn(_labels(found), training)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            texts = [_redacted(value.as_py(), network, mask) for value in batch.column(at)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return documents.mapInArrow(rewrite, documents.schema)


def _redacted(text: str | None, network: Network, mask: str) -> str | None:
    if not text:
        return text
    spans = candidates(text)
    if not spans:
        return text
    learned = [i for i, s in enumerate(spans) if s[2] == "learned"]
    scores = network.probability([surroundings(text, *spans[i][3:]) for i in learned])
    dropped = {i for i, score in zip(learned, scores, strict=True) if score < network.threshold}
    parts, end = [], 0
    for low, high in sorted(s[3:] for i, s in enumerate(spans) if i not in dropped):
        if low >= end:
            parts += [text[end:low], mask]
        end = max(end, high)
    return "".join([*parts, text[end:]])
