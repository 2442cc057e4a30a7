"""Language-model scores from a hidden Markov model with an emission for every word.

States and transitions are learned over word classes: the commonest words are a class
each, every other word belongs to the class of its last letters. Then the states'
expected counts of every word of the training rows are a table by word, as long as the
vocabulary. A word's mass is its count + 0.5, shared out to the states by these counts
plus ``lean`` counts dealt as its class's, so words met seldom lean on their class; an
unseen word has the mass 0.5 and its class's shares. A state's emissions are its masses
over their sum. (Rare words' shares are rounded to 11 bits, and so are in that sum.)

* Word counts of all training documents are summed per task, then over the corpus.
* Baum-Welch, incremental: training documents are dealt to ``parts`` by a hash of their
  text; every iteration goes over all of them, part after part, and the model is
  maximised after each part. Tasks sum their expected transition, emission and start
  counts, and these sums are added up. In the last iteration a part's counts replace its
  earlier ones, so the model is that of one set of counts over all rows; before, counts
  of earlier parts fade, as they are from a model still far off. A training sequence is
  a stretch of at most ``stretch`` tokens; a later stretch of a document starts from the
  states' overall shares.
* A document's score is the exact log-likelihood of its whole token sequence by the
  scaled forward recursion, batched over documents.
* The counts and emissions of rare words come by a join; the commonest (``known_words``,
  at most 64 bytes each) are broadcast. The rest of the vocabulary may be of any size.

Tokens are lower-cased (A-Z) words between ASCII white space, then one end token.

Defined results: null text counts as empty and has the end token alone; a null id is
never held out; repeated rows are counted and scored each; without training tokens
every count is zero and the formulas hold; an empty table gives no rows; further
columns of the input are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelstride.llm.common import text_of, written

END = b""  # no word is empty
LOG10 = 1 / np.log(10)


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]  # of bytes: A-Z and ASCII white space only


def _texts(batches: Iterator[pa.RecordBatch], column: int, rows: int = 512):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).cast(pa.binary()).to_pylist()


def word_counts(train: DataFrame, endings: int, flush: int = 200_000) -> DataFrame:
    """What the choice of common words needs of all rows of ``train`` (column ``text``):
    ``word``, ``c`` of words that a task meets twice or more among ``flush`` distinct ones,
    and (``word`` null) ``e``, ``c``: all tokens by ending class. Common words come from
    the first, the number of tokens from the second; exact counts of all words are summed
    later, with their states."""
    def each(batches):
        def out():
            often = {w: c for w, c in seen.items() if c > 1}
            return pa.RecordBatch.from_arrays(
                [pa.array(list(often), pa.binary()), pa.nulls(len(often), pa.int32()), pa.array(list(often.values()), pa.int64())],
                names=["word", "e", "c"])

        def ended():
            at = [end_of[w[-3:]] for w in seen]
            classes[:] += np.bincount(at, np.fromiter(seen.values(), np.int64, len(seen)), endings).astype(np.int64)

        seen: Counter = Counter()
        classes, end_of = np.zeros(endings, np.int64), Endings(endings)
        for _, texts in _texts(batches, 0):
            for t in texts:
                seen.update(tokens(t))
            if len(seen) > flush:
                yield out()
                ended()
                seen.clear()
        yield out()
        ended()
        yield pa.RecordBatch.from_arrays([pa.nulls(endings, pa.binary()), pa.array(np.arange(endings), pa.int32()), pa.array(classes)],
                                         names=["word", "e", "c"])

    return (train.select("text").mapInArrow(each, "word binary, e int, c long")
            .groupBy("word", "e").agg(F.sum("c").alias("c")))


def common_from(counts: DataFrame, most: int) -> int:
    """The count from which words are among the (at most) ``most`` commonest."""
    steps = 16  # of the histogram, to a doubling: its size doesn't depend on the corpus
    rows = (counts.where("word IS NOT NULL").groupBy(F.floor(F.log2("c") * steps).cast("long").alias("b")).count()
            .orderBy(F.desc("b")).collect())
    total, least = 0, None
    for r in rows:
        total += r["count"]
        if total > most:
            break
        least = r.b
    return int(np.ceil(2 ** (least / steps) - 1e-9)) if least is not None else 1 << 62


def ending_class(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-3:]) % classes


class Endings(dict):
    """Ending classes by a word's last three bytes, remembered up to a million of them."""

    def __init__(self, classes: int):
        super().__init__()
        self.classes = classes

    def __missing__(self, tail: bytes) -> int:
        found = ending_class(tail, self.classes)
        if len(self) < 1_000_000:
            self[tail] = found
        return found


@dataclass
class Vocabulary:
    """The common words and the class of each; every class's weight in the corpus."""

    words: list[bytes]
    group: np.ndarray
    weight: np.ndarray
    own: int

    def codes(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.words)}


_codes: dict[str, dict[bytes, int]] = {}


def vocabulary(counts: DataFrame, known_words: int, own_words: int, endings: int) -> Vocabulary:
    """From the table of counts: common words and the ending classes' sums to the driver."""
    common = (F.col("c") >= common_from(counts, known_words)) & (F.length("word") <= 64)
    found = counts.where("word IS NOT NULL").where(common | (F.length("word") == 0)).toPandas()  # the end token is always known
    found = found.assign(word=found["word"].map(bytes)).sort_values(["c", "word"], ascending=[False, True])
    found = found.iloc[np.argsort(found["word"] != END, kind="stable")]  # the end token first, then by count
    words, c = found["word"].tolist(), found["c"].to_numpy(np.int64)
    if not words or words[0] != END:  # no training tokens, or a document alone in its task
        words, c = [END, *words], np.concatenate(([0], c))
    own = min(own_words, len(words))
    total = np.zeros(endings)
    for r in counts.where("word IS NULL").select("e", "c").collect():  # bounded: a row for each ending class
        total[r[0]] = r[1]
    ends = np.array([ending_class(w, endings) for w in words], np.int64)
    np.subtract.at(total, ends[:own], c[:own])
    group = np.arange(len(words))
    group[own:] = own + ends[own:]
    weight = np.concatenate((c[:own], np.maximum(total, 0))) + 0.5
    return Vocabulary(words, group.astype(np.int16), weight, own)


SEQUENCES = ("row long, doc_id long, held_out boolean, n_tokens long, codes binary, rare binary, "
             "rare_groups binary, part int")


def packed(codes: np.ndarray) -> bytes:
    """Four-byte numbers with their byte planes apart, so that the column packs well."""
    return np.ascontiguousarray(codes, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def rare_words(rare: bytes) -> list[bytes]:
    """A document's distinct rare words: no word holds a space."""
    return rare.split(b" ") if rare else []


def classes_of(codes: np.ndarray, rare_groups: bytes, group: np.ndarray) -> np.ndarray:
    """Each token's class: a common word's own, a rare word's by its place in the list."""
    out = group[np.maximum(codes, 0)]
    miss = np.flatnonzero(codes < 0)
    if len(miss):
        out[miss] = np.frombuffer(rare_groups, "<i2")[-1 - codes[miss]]
    return out


def sequences(rows: DataFrame, shared, key: str, endings: int) -> DataFrame:
    """Each document as codes. A code is a common word's, or -1 - its place in the list of
    the document's distinct rare words, whose classes are listed beside them. ``shared``
    broadcasts the vocabulary; ``key`` names it in a worker's memory."""
    def each(batches):
        v: Vocabulary = shared.value
        if key not in _codes:
            _codes.clear()  # of an earlier corpus
            _codes[key] = v.codes()
        code, end_of = _codes[key].get, Endings(endings)
        for part, texts in _texts(batches, 3):
            n, codes, rare, groups = [], [], [], []
            for t in texts:
                ws = tokens(t)
                at = np.fromiter(map(code, ws, repeat(-1)), np.int32, len(ws))
                some: dict[bytes, int] = {}
                miss = np.flatnonzero(at < 0)
                at[miss] = [-1 - some.setdefault(ws[k], len(some)) for k in miss.tolist()]
                n.append(len(ws))
                codes.append(packed(at))
                rare.append(b" ".join(some))
                groups.append(np.array([v.own + end_of[w[-3:]] for w in some], "<i2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(n, pa.int64()), pa.array(codes, pa.binary()),
                 pa.array(rare, pa.binary()), pa.array(groups, pa.binary()), part.column(4)],
                names=["row", "doc_id", "held_out", "n_tokens", "codes", "rare", "rare_groups", "part"])

    return rows.select("row", "doc_id", "held_out", "text", "part").mapInArrow(each, SEQUENCES)


# --- the hidden Markov model -------------------------------------------------------


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # from state, to state
    emit: np.ndarray  # class, state
    share: np.ndarray  # of each state in all tokens


class Packed:
    """Sequences side by side: all first tokens, then all second tokens, and so on,
    longest sequence first, so that each step of a recursion is one small product."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        steps = int(lengths[0]) if len(lengths) else 0
        self.width = len(lengths) - np.searchsorted(lengths[::-1], np.arange(steps), side="right")
        self.at = np.concatenate(([0], np.cumsum(self.width)))
        rank = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(rank)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = self.at[step] + rank
        self.tokens = np.empty(len(rank), np.int64)
        if len(rank):
            self.tokens[place] = np.concatenate([sequences[k] for k in self.order])
        self.rank = np.empty(len(rank), np.int64)
        self.rank[place] = rank

    def forward(self, model: Model, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled state probabilities, scale factors and emissions of all tokens."""
        seen = model.emit[self.tokens]
        state, scale = np.empty_like(seen), np.empty(len(seen), seen.dtype)
        now = starts[self.order]
        for a, n in zip(self.at.tolist(), self.width.tolist(), strict=False):
            now = now[:n] * seen[a:a + n]
            c = now.sum(1)
            now /= c[:, None]
            state[a:a + n], scale[a:a + n] = now, c
            now = now @ model.move
        return state, scale, seen

    def log_likelihoods(self, model: Model) -> np.ndarray:
        """Natural log-likelihood of each sequence, in the order given."""
        starts = np.broadcast_to(model.start, (len(self.order), len(model.start)))
        _, scale, _ = self.forward(model, starts)
        out = np.empty(len(self.order))
        out[self.order] = np.bincount(self.rank, np.log(scale.astype(np.float64)), len(self.order))
        return out

    def posteriors(self, model: Model, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """State posteriors of all tokens, and what transition counts are made of.
        ``first``: the sequences that begin a document."""
        starts = np.where(first[:, None], model.start, model.share)
        state, scale, seen = self.forward(model, starts)
        later = np.ones_like(state)
        weighed = seen / scale[:, None]
        for t in range(len(self.width) - 2, -1, -1):
            a, b, n = self.at[t], self.at[t + 1], self.width[t + 1]
            weighed[b:b + n] *= later[b:b + n]
            later[a:a + n] = weighed[b:b + n] @ model.move.T
        return state * later, state, weighed

    def expected(self, model: Model, first: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected start, transition and emission counts."""
        gamma, state, weighed = self.posteriors(model, first)
        behind = np.arange(self.at[1] if len(self.width) else 0, len(state))
        before = behind - np.repeat(self.width[:-1], self.width[1:])
        move = model.move * (state[before].T.astype(np.float64) @ weighed[behind]) if len(behind) else 0 * model.move
        begin = gamma[:self.at[1]][first[self.order]].sum(0) if len(self.width) else np.zeros(len(model.start))
        emit = np.stack([np.bincount(self.tokens, gamma[:, k], classes) for k in range(len(model.start))], 1)
        return begin.astype(np.float64), move, emit


def first_model(states: int, shares: np.ndarray, seed: int) -> Model:
    """Classes by their corpus shares, a little different in each state; states last."""
    rng = np.random.default_rng(seed)
    emit = shares[:, None] * rng.uniform(0.5, 1.5, (len(shares), states))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    even = np.full(states, 1 / states)
    return _model(even, move, emit / emit.sum(0), even)


def _model(start, move, emit, share) -> Model:
    return Model(*(np.ascontiguousarray(x, np.float32) for x in (start, move, emit, share)))


def maximised(begin, move, emit, shares: np.ndarray, prior: float = 50.0) -> Model:
    """The model for expected counts; emissions lean on the corpus shares."""
    states = len(begin)
    each = emit.sum(0)
    return _model((begin + 1) / (begin.sum() + states), (move + 1) / (move.sum(1, keepdims=True) + states),
                  (emit + prior * shares[:, None]) / (each + prior), (each + 1) / (each.sum() + states))


def stretches(groups: list[np.ndarray], stretch: int) -> tuple[list[np.ndarray], np.ndarray]:
    cut = [g[a:a + stretch] for g in groups for a in range(0, len(g), stretch)]
    first = [a == 0 for g in groups for a in range(0, len(g), stretch)]
    return cut, np.array(first, bool)


def _grouped(batches: Iterator[pa.RecordBatch], numbers_of, most: int):
    """Rows and each one's numbers, about ``most`` tokens at a time."""
    rows, numbers, size = [], [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            numbers.append(numbers_of(batch, k))
            rows.append((batch, k))
            size += len(numbers[-1])
            if size >= most:
                yield rows, numbers
                rows, numbers, size = [], [], 0
    if rows:
        yield rows, numbers


def _codes_in(column: int):
    return lambda batch, k: unpacked(batch.column(column)[k].as_py())


def _listed(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return batch.column(0)[k].values.to_numpy(zero_copy_only=False)


def baum_welch(train: DataFrame, classes: int, shares: np.ndarray, states: int = 8, iterations: int = 2,
               parts: int = 8, fade: float = 0.5, stretch: int = 512, batch_tokens: int = 200_000,
               seed: int = 0, columns: tuple[str, ...] = ("groups",), groups_of=_listed) -> Model:
    """Fit on all rows of ``train`` (columns ``part`` from 0 to ``parts - 1``, and
    ``groups``, or those of which ``groups_of`` makes a row's classes)."""
    names = [f"s{k}" for k in range(states)]

    def expected(rows: DataFrame, model: Model) -> np.ndarray:
        now = train.sparkSession.sparkContext.broadcast(model)  # bounded: states * classes numbers

        def counts(batches):
            m = now.value
            begin, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((classes, states))
            for _, groups in _grouped(batches, groups_of, batch_tokens):
                cut, first = stretches(groups, stretch)
                for total, more in zip((begin, move, emit), Packed(cut).expected(m, first, classes), strict=True):
                    total += more
            table = np.concatenate((emit, move, begin[None]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(table)), pa.int32()), *[pa.array(table[:, k]) for k in range(states)]],
                names=["part", *names])

        sums = np.zeros((classes + states + 1, states))
        for r in (rows.select(*columns).mapInArrow(counts, ", ".join(["part int", *[f"{n} double" for n in names]]))
                  .groupBy("part").agg(*[F.sum(n) for n in names]).collect()):  # bounded as the model
            sums[r[0]] = r[1:]
        now.unpersist()
        return sums

    model = first_model(states, shares, seed)
    found = np.zeros((parts, classes + states + 1, states))  # of each part, from its latest visit
    recent = np.zeros(found.shape[1:])
    for turn in range(iterations):
        for p in range(parts):
            found[p] = expected(train.where(F.col("part") == p), model)
            if not found[p, -1].any():  # no rows
                continue
            recent = fade * recent + found[p]
            sums = found.sum(0) if turn == iterations - 1 else recent
            model = maximised(sums[-1], sums[classes:-1], sums[:classes], shares)
    return model


def _token_ids(codes: np.ndarray, rare_ids: np.ndarray) -> np.ndarray:
    """Ids of a document's tokens: codes, and for rare words ``rare_ids``."""
    ids = codes.astype(np.int64)
    miss = np.flatnonzero(ids < 0)
    ids[miss] = rare_ids[-1 - ids[miss]]
    return ids


#: Expected counts of rare words are kept as whole numbers of so many parts.
PARTS = 1024


def word_state_counts(train: DataFrame, shared, model: Model, stretch: int = 512,
                      batch_tokens: int = 200_000, flush: int = 600_000) -> DataFrame:
    """``word`` (null for common words), ``code`` (null for others), ``n`` and the
    expected counts ``s0``, ... of the states in 1/1024, over all rows of ``train``
    (columns ``codes``, ``rare``, ``rare_groups``). A task sums up to ``flush`` rare words
    before it sends them."""
    states = len(model.start)
    names = [f"s{k}" for k in range(states)]
    fitted = train.sparkSession.sparkContext.broadcast(model)  # bounded: states * classes numbers

    def each(batches):
        m, v = fitted.value, shared.value
        known = len(v.words)

        def out(words, codes, n, sums):
            whole = np.round(sums * PARTS).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(codes, pa.int32()), pa.array(n, pa.int64()),
                 *[pa.array(whole[:, k]) for k in range(states)]], names=["word", "code", "n", *names])

        total, met = np.zeros((known, states)), np.zeros(known, np.int64)
        index: dict[bytes, int] = {}  # rare words since the last sending
        held, held_n = np.zeros((0, states)), np.zeros(0, np.int64)
        for rows, codes in _grouped(batches, _codes_in(0), batch_tokens):
            ids, groups = [], []
            for (b, k), c in zip(rows, codes, strict=True):
                at = [known + index.setdefault(w, len(index)) for w in rare_words(b.column(1)[k].as_py())]
                ids.append(_token_ids(c, np.array(at, np.int64)))
                groups.append(classes_of(c, b.column(2)[k].as_py(), v.group))
            cut, first = stretches(groups, stretch)
            gamma = Packed(cut).posteriors(m, first)[0]
            at = Packed(stretches(ids, stretch)[0]).tokens  # of the same lengths, so in the same order
            size = known + len(index)
            sums = np.stack([np.bincount(at, gamma[:, k], size) for k in range(states)], 1)
            n = np.bincount(at, minlength=size)
            total += sums[:known]
            met += n[:known]
            more = len(index) - len(held)
            held = np.concatenate((held, np.zeros((more, states)))) + sums[known:]
            held_n = np.concatenate((held_n, np.zeros(more, np.int64))) + n[known:]
            if len(index) >= flush:
                yield out(list(index), [None] * len(index), held_n, held)
                index, held, held_n = {}, held[:0], held_n[:0]
        if index:
            yield out(list(index), [None] * len(index), held_n, held)
        some = np.flatnonzero(met)
        yield out([None] * len(some), some, met[some], total[some])

    return (train.select("codes", "rare", "rare_groups")
            .mapInArrow(each, ", ".join(["word binary, code int, n long", *[f"{n} long" for n in names]]))
            .groupBy("word", "code").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names]))


def masses(n: np.ndarray, sums: np.ndarray, shares: np.ndarray, lean: float) -> np.ndarray:
    """Words' masses in each state, from their counts and their classes' shares of states."""
    return (n + 0.5)[:, None] * (sums + lean * shares) / (sums.sum(1, keepdims=True) + lean)


#: The least share of a state in a rare word's mass: shares are kept with 11 bits.
LEAST_SHARE = 2.0 ** -14


def _masses_kept(numbers: np.ndarray) -> np.ndarray:
    return (numbers["n"] + 0.5)[:, None] * numbers["share"].astype(float)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = 8,
          iterations: int = 2, known_words: int = 100_000, own_words: int = 8192, endings: int = 512,
          parts: int = 8, lean: float = 2.0, batch_tokens: int = 200_000, seed: int = 0) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (smoothed unigrams), ``score`` (the model)."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                      text_of(text_col).alias("text"))
    counts = written(word_counts(src.where(~F.col("held_out")), endings), "counts")
    n = counts.where("word IS NULL").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    words = vocabulary(counts, known_words, own_words, endings)
    shared = spark.sparkContext.broadcast(words)  # bounded: known_words words of 64 bytes at most
    rows = (src.withColumn("row", F.monotonically_increasing_id())
            .withColumn("part", F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int")))
    table = written(sequences(rows, shared, uuid.uuid4().hex, endings), "sequences")

    own, share = words.own, words.weight
    train = table.where(~F.col("held_out"))

    def groups_of(batch, k):
        return classes_of(unpacked(batch.column(0)[k].as_py()), batch.column(1)[k].as_py(), shared.value.group)

    model = baum_welch(train, own + endings, share / share.sum(), states, iterations, parts, batch_tokens=batch_tokens,
                       seed=seed, columns=("codes", "rare_groups"), groups_of=groups_of)

    names = [f"s{k}" for k in range(states)]
    by_word = written(word_state_counts(train, shared, model, batch_tokens=batch_tokens), "word_states")
    of_class = model.emit.astype(np.float64) * model.share
    of_class /= of_class.sum(1, keepdims=True)
    found = by_word.where("code IS NOT NULL").drop("word").toPandas()  # bounded: the known words
    met, sums = np.zeros(len(words.words)), np.zeros((len(words.words), states))
    met[found["code"]], sums[found["code"]] = found["n"], found[names] / PARTS
    common = masses(met, sums, of_class[words.group], lean)
    numbers_of = np.dtype([("n", "<u4"), ("share", "<f2", (states,))])  # what a rare word's row holds

    def rare_numbers(b):
        """Counts and shares of the states, as they are kept."""
        end_of = Endings(endings)
        ends = np.array([end_of[w[-3:]] for w in b.column(0).to_pylist()], np.int64)
        n = b.column(1).to_numpy()
        mass = masses(n, np.stack([b.column(2 + k).to_numpy() / PARTS for k in range(states)], 1), of_class[own + ends], lean)
        numbers = np.empty(len(n), numbers_of)
        numbers["n"], numbers["share"] = n, np.maximum(mass / (n + 0.5)[:, None], LEAST_SHARE)
        return numbers

    def of_rare(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([r.tobytes() for r in rare_numbers(b)], pa.binary())], names=["word", "numbers"])

    def summed(batches):
        total = np.zeros(states)
        for b in batches:
            if b.num_rows:
                total += _masses_kept(rare_numbers(b)).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(states), pa.int32()), pa.array(total)], names=["k", "v"])

    by_rare = by_word.where("code IS NULL").select("word", "n", *names)
    v = int((met > 0).sum()) + by_rare.count()  # every word of the training rows
    # and, for each ending class, a word not seen
    whole = common.sum(0) + 0.5 * of_class[own:].sum(0)
    for r in by_rare.mapInArrow(summed, "k int, v double").groupBy("k").agg(F.sum("v")).collect():
        whole[r[0]] += r[1]  # a row for each state
    rare = by_rare.mapInArrow(of_rare, "word binary, numbers binary")
    common_emit = (common / whole).astype(np.float32)
    fitted = spark.sparkContext.broadcast((model, common_emit, 0.5 * of_class[own:], met, whole))  # bounded: known_words

    def likelihoods(batches):
        m, emit, unseen, common_n, total = fitted.value
        for rows, codes in _grouped(batches, _codes_in(3), 4 * batch_tokens):  # long texts are few: many side by side
            ids, more, more_n, size = [], [], [], len(emit)
            for (b, k), c in zip(rows, codes, strict=True):
                some = np.frombuffer(b.column(4)[k].as_py(), "<i2")  # the rare words' classes
                mass = unseen[some - own]
                seen = np.zeros(len(some))
                hits = b.column(5)[k].values
                if hits is not None and len(hits):
                    at, found = hits.flatten()
                    numbers = np.frombuffer(b"".join(found.to_pylist()), numbers_of)
                    mass[at.to_numpy()], seen[at.to_numpy()] = _masses_kept(numbers), numbers["n"]
                ids.append(_token_ids(c, size + np.arange(len(some))))
                more.append(mass)
                more_n.append(seen)
                size += len(some)
            every = np.concatenate((emit, (np.concatenate(more) / total).astype(np.float32)))
            every_n = np.concatenate((common_n, *more_n))
            logs = Packed(ids).log_likelihoods(Model(m.start, m.move, every, m.share)) * LOG10
            count_log, known = np.log10(every_n + 0.5), every_n > 0
            base, n_known = np.array([count_log[i].sum() for i in ids]), np.array([known[i].sum() for i in ids])
            done = 0
            while done < len(rows):  # rows of one batch at a time
                batch, k = rows[done]
                until = done
                while until < len(rows) and rows[until][0] is batch:
                    until += 1
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(k, until - done).columns[:3], pa.array(n_known[done:until], pa.int64()),
                     pa.array(base[done:until]), pa.array(logs[done:until])],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "count_log", "log"])
                done = until

    asked = table.where(F.octet_length("rare") > 0).select(
        "row", F.posexplode(F.split(F.col("rare").cast("string"), " ")).alias("at", "word"))
    hits = (asked.withColumn("word", F.col("word").cast("binary")).join(rare, "word")
            .groupBy("row").agg(F.collect_list(F.struct("at", "numbers")).alias("hits")))  # a document's words
    scored = (table.join(hits, "row", "left").select("doc_id", "held_out", "n_tokens", "codes", "rare_groups", "hits")
              .mapInArrow(likelihoods, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                       "count_log double, log double"))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("count_log") - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))).alias("base_score"),
        F.col("log").alias("score"))
