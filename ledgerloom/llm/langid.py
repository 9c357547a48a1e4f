"""Language by unigram piece models, with the probability of a text summed over all its segmentations.

Pieces are those of a fixed public vocabulary; each language has its own piece probabilities.  No piece spans
a word boundary, so the forward sum over all segmentations of a text is the product of the forward sums of its
words, and each word is summed once per cache.  The probabilities are fitted by expectation maximisation with
the same lattice (forward and backward sums) on word counts; expected counts are added up in Spark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.quality import held_out
from ledgerloom.llm.words import map_batches
from ledgerloom.scale import durable

VOCABULARY = "piece_bpe_32k.model"
#: About so many different training texts the piece probabilities are fitted on, each weighted by its copies
#: (drawn by hash, an equal share for each language; priors cover all training rows).
FIT_ROWS = 8_000
ROUNDS = 2
#: Characters summed at a time; a longer word hands its last sums, rescaled, to its next slice.
SLICE = 24
#: Characters of the words that are summed together.
_BLOCK = 100_000
#: Probability of a character that is no piece, the same in every language.
UNKNOWN = 1e-5
_WORDS_HELD = 300_000
#: ASCII letters are lower-cased, other ASCII characters separate words, all else is kept.
_LETTERS = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))


class Vocabulary:
    """Trie over the normal pieces of a SentencePiece model, as sorted (state, character) keys.

    The word-start mark belongs to the piece.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        children: dict[int, int] = {}
        pieces, self.size, self.longest = [-1], 0, 1
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
                continue
            state = 0
            for character in model.id_to_piece(i):
                key = state << 21 | ord(character)
                state = children.setdefault(key, len(pieces))
                if state == len(pieces):
                    pieces.append(-1)
            pieces[state] = self.size
            self.size += 1
            self.longest = max(self.longest, len(model.id_to_piece(i)))
        self.keys = np.array(sorted(children), dtype=np.int64)
        self.states = np.array([children[k] for k in self.keys.tolist()], dtype=np.int64)
        self.pieces = np.array(pieces, dtype=np.int64)

    def lattice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Edges (word, from, to, piece) of all segmentations; piece ``size`` is a single unknown character.

        All starts of all words walk down the trie together, one character at a time.
        """
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        first = np.cumsum(lengths) - lengths
        begin = np.arange(len(letters))
        live, state, depth = begin, np.zeros(len(letters), dtype=np.int64), 0
        edges, single = [], np.zeros(len(letters), dtype=bool)
        stop = (first + lengths)[word]
        while len(live):
            key = state << 21 | letters[live + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            live, state, depth = live[found], self.states[at[found]], depth + 1
            piece = self.pieces[state]
            full = piece >= 0
            edges.append((live[full], np.full(full.sum(), depth), piece[full]))
            if depth == 1:
                single[live[full]] = True
            more = live + depth < stop[live]
            live, state = live[more], state[more]
        alone = begin[~single]
        edges.append((alone, np.ones(len(alone), dtype=np.int64), np.full(len(alone), self.size)))
        start, span, piece = (np.concatenate(x) for x in zip(*edges, strict=True))
        number = word[start]
        return number, start - first[number], start - first[number] + span, piece


_HELD: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _HELD:
        _HELD[path] = Vocabulary(path)
    return _HELD[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def marked(word: str) -> str:
    return "▁" + word


def _sweep(table: np.ndarray, rows: np.ndarray, to: np.ndarray, source: np.ndarray, factor: np.ndarray,
           positions) -> np.ndarray:
    """Add to ``table[row, to]`` the sums of ``table[row, source] * factor``, one position after another."""
    order = np.lexsort((rows, to))
    rows, to, source, factor = rows[order], to[order], source[order], factor[order]
    for at in positions:
        low, high = np.searchsorted(to, (at, at + 1))
        if low < high:
            row = rows[low:high]
            cut = np.flatnonzero(np.diff(row, prepend=-1))
            table[row[cut], at] += np.add.reduceat(table[row, source[low:high]] * factor[low:high], cut, axis=0)
    return table


def _blocks(words: list[str]) -> Iterator[np.ndarray]:
    """Positions of words of like length, in blocks of about ``_BLOCK`` characters (one word at least)."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    begin = 0
    while begin < len(order):
        end = begin + 1
        while end < len(order) and end - begin < 4096 and lengths[order[end]] * (end + 1 - begin) <= _BLOCK:
            end += 1
        yield order[begin:end]
        begin = end


def sliced_forward(
    held: Vocabulary, words: list[str], probability: np.ndarray, langs: np.ndarray | None = None, kept: list | None = None
) -> np.ndarray:
    """Log of the sum over all segmentations of each word, per language, or of its own language in ``langs``.

    The sums run over slices of ``SLICE`` starts.  A piece may end beyond its slice, so the sums of the next
    ``longest`` positions are handed on, divided by their largest.  ``kept`` collects what :func:`sliced_counts`
    needs of each slice.
    """
    width, lengths = held.longest, np.array([len(w) for w in words], dtype=np.int64)
    count = probability.shape[1] if langs is None else 1
    carry, scale = np.zeros((len(words), width, count)), np.zeros((len(words), count))
    carry[:, 0] = 1.0
    out = np.zeros((len(words), count))
    for begin in range(0, int(lengths.max(initial=0)), SLICE):
        live = np.flatnonzero(lengths > begin)
        edges = held.lattice([words[i][begin : begin + SLICE + width - 1] for i in live])
        number, start, end, piece = (x[edges[1] < SLICE] for x in edges)
        factor = probability[piece] if langs is None else probability[piece, langs[live][number]][:, None]
        table = np.zeros((len(live), SLICE + width, count))
        table[:, :width] = carry[live]
        _sweep(table, number, end, start, factor, range(1, SLICE + width))
        if kept is not None:
            kept.append((begin, live, (number, start, end, piece), factor, table, scale[live]))
        rest = lengths[live] - begin
        ends, goes = np.flatnonzero(rest <= SLICE), np.flatnonzero(rest > SLICE)
        out[live[ends]] = np.log(np.maximum(table[ends, rest[ends]], 1e-300)) + scale[live[ends]]
        top = np.maximum(table[goes, SLICE:].max(axis=1), 1e-300)
        carry[live[goes]] = table[goes, SLICE:] / top[:, None]
        scale[live[goes]] += np.log(top)
    return out


def sliced_counts(
    held: Vocabulary, words: list[str], langs: np.ndarray, probability: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word, piece, expected uses) over all segmentations of each word in its language, slice by slice from the end."""
    kept: list = []
    total = sliced_forward(held, words, probability, langs, kept)[:, 0]
    width, lengths = held.longest, np.array([len(w) for w in words], dtype=np.int64)
    carry, scale = np.zeros((len(words), width, 1)), np.zeros(len(words))
    while kept:
        begin, live, (number, start, end, piece), factor, alpha, before = kept.pop()
        rest = lengths[live] - begin
        beta = np.zeros_like(alpha)
        beta[:, SLICE:] = carry[live]
        ends = np.flatnonzero(rest <= SLICE)
        beta[ends, rest[ends]] = 1.0
        _sweep(beta, number, start, end, factor, range(SLICE - 1, -1, -1))
        share = alpha[number, start, 0] * factor[:, 0] * beta[number, end, 0]
        yield live[number], piece, share * np.exp(before[:, 0] + scale[live] - total[live])[number]
        top = np.maximum(beta[:, :width].max(axis=1), 1e-300)
        carry[live] = beta[:, :width] / top[:, None]
        scale[live] += np.log(top[:, 0])


def log_sums(held: Vocabulary, words: list[str], probability: np.ndarray) -> np.ndarray:
    """Log of the forward sum of each word, per language."""
    pieces = [marked(word) for word in words]
    out = np.zeros((len(words), probability.shape[1]))
    for block in _blocks(pieces):
        out[block] = sliced_forward(held, [pieces[i] for i in block], probability)
    return out


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def _word_counts(batch: pa.RecordBatch) -> dict:
    totals: dict[str, Counter] = {}
    for lang, text, copies in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "copies")), strict=True):
        held = totals.setdefault(lang, Counter())
        for word, n in Counter(words_of(text)).items():
            held[word] += n * copies
    rows = [(lang, word.decode("utf-8", "replace"), n) for lang, c in totals.items() for word, n in c.items()]
    return dict(zip(("lang", "word", "n"), map(list, zip(*rows, strict=True)), strict=True)) if rows else None


def _expected(path: str, languages: list[str], shared):
    """Expected piece counts of a batch of (lang, word, n) under the shared probabilities."""

    def run(batch: pa.RecordBatch) -> dict | None:
        held, probability = vocabulary(path), shared.value
        langs = np.array([languages.index(x) for x in batch.column("lang").to_pylist()], dtype=np.int64)
        counts = np.asarray(batch.column("n"), dtype=np.float64)
        totals = np.zeros((held.size + 1, len(languages)))
        words = batch.column("word").to_pylist()
        pieces = [marked(word) for word in words]
        for block in _blocks(pieces):
            for word, piece, expected in sliced_counts(held, [pieces[i] for i in block], langs[block], probability):
                np.add.at(totals, (piece, langs[block][word]), expected * counts[block][word])
        piece, lang = np.nonzero(totals)
        return {"piece": piece, "lang": [languages[k] for k in lang], "expected": totals[piece, lang]}

    return run


def fit(training: DataFrame, path: str, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS) -> dict | None:
    """Languages, their priors over all training rows and piece probabilities; ``None`` without training rows."""
    spark = training.sparkSession
    texts = F.approx_count_distinct(F.xxhash64("text"))
    sizes = training.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), texts.alias("texts")).collect()
    seen, different = {r["lang"]: r["n"] for r in sizes}, {r["lang"]: r["texts"] for r in sizes}
    if not seen:
        return None
    languages, total = sorted(seen), sum(seen.values())
    # A language of no more texts than its share is taken whole; a text with many copies is one row of the sample.
    each = fit_rows / len(languages)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, int(1_000_003 * min(1.0, each / max(1, different[k]))) + 1)])
    drawn = training.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < share[F.col("lang")])
    drawn = drawn.groupBy("lang", "text").agg(F.count(F.lit(1)).alias("copies"))
    counts = durable(
        map_batches(drawn, "lang string, word string, n long", _word_counts)
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    size = vocabulary(path).size
    probability = np.full((size + 1, len(languages)), 1.0 / size)
    probability[size] = UNKNOWN
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(probability)
        sums = map_batches(counts, "piece long, lang string, expected double", _expected(path, languages, shared))
        rows = sums.groupBy("piece", "lang").agg(F.sum("expected").alias("expected")).toArrow()
        expected = np.zeros((size + 1, len(languages)))
        language = [languages.index(x) for x in rows["lang"].to_pylist()]
        expected[rows["piece"].to_numpy(), language] = rows["expected"].to_numpy()
        expected = expected[:size] + 0.01
        probability = np.vstack([expected / expected.sum(axis=0), np.full((1, len(languages)), UNKNOWN)])
    prior = np.log(np.array([seen[k] for k in languages]) / total)
    return {"languages": languages, "prior": prior, "probability": probability}


class _Scorer:
    """Word sums of one model, remembered within a worker."""

    def __init__(self, path: str, model: dict) -> None:
        self.vocabulary, self.model = vocabulary(path), model
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.sums = np.empty((0, len(self.model["languages"])))

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.index]
        if len(self.index) + len(new) > _WORDS_HELD and self.index:
            self.clear()
            new = list(words)
        if new:
            sums = log_sums(self.vocabulary, [w.decode("utf-8", "replace") for w in new], self.model["probability"])
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.sums = np.vstack([self.sums, sums])

    def score(self, words: list[bytes]) -> np.ndarray:
        at = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        return self.sums[at].sum(axis=0) + self.model["prior"]


def detect(docs: DataFrame, path: str | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, lang_pred, score``.

    Learns from rows with a text and a language outside the held-out third.  A null text or one without a
    letter is ``und`` with score 0, and so is every text if there is nothing to learn from.  ``score`` is the
    posterior of the predicted language.  Other columns are ignored; an empty table gives no rows.
    """
    path = path or default_vocabulary()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
        F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    training = rows.where(F.col("lang").isNotNull() & F.col("letters") & ~held_out(F.col("doc_id")))
    model = fit(training.select("lang", "text"), path, fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    target = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(path, shared.value) if shared.value else None
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                texts, letters = batch.column("text").to_pylist(), batch.column("letters").to_pylist()
                split = [words_of(t) if has and scorer else None for t, has in zip(texts, letters, strict=True)]
                if scorer:
                    scorer.learn(set().union(*(s for s in split if s)))
                names, scores = [], []
                for words in split:
                    if words is None:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    logs = scorer.score(words)
                    best = int(np.argmax(logs))
                    names.append(scorer.model["languages"][best])
                    scores.append(float(1.0 / np.exp(logs - logs[best]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(names), pa.array(scores, pa.float64())],
                    schema=target,
                )

    scored = rows.select("doc_id", "text", "letters").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
