"""Toxicity by a weighted finite-state grammar over clauses.

Words become the symbols insult, threat, intent, target, negation and report, in four languages; all others are gaps.
Four small transducers read the symbols of a clause: negation and intent hold for the next few words, target and
report for the rest of the clause. ``compose`` makes one table of them (next joint state and factor for every state
and letter), in which a letter also says whether the word stands in quotation marks. A matched insult or threat leaves
the composition with its weight times the factor of the joint state. A document is scored by its matched clauses
(their number, sum and maximum), not by single words, through a logistic model.

Weights come from labelled rows that are not held out: a bounded sample of ``sample`` of them. A word, or a
stem (its first letters), is learned as an insult if it stands in ``MIN_CONTEXTS`` different surroundings or
more (copies of one document count once) of toxic documents, and the lower end of the confidence interval of
its log odds reaches ``MIN_LOG_ODDS``. The support is the same for every size of sample, so words of a smaller
language are learned as well. Labels of held-out rows are never read, nor are lang, source or doc_id.

A null or empty text matches nothing and gets the score of a text without clauses. Without usable labels
the prior weights serve. A row without doc_id counts as held out. Rows that share a doc_id enter the sample with one
of their texts. Equal texts get equal scores; other columns are ignored. An empty table gives an empty result, and a
very long text is a slice of its own, read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field as default

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billmill.llm.steps import stored
from billmill.llm.words import LOWER, Words, field, mix, slices, span_hashes, text_bytes

INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT = 1, 2, 3, 4, 5, 6

# Prior symbols; insults in other words are learned. Every text is read with the words of all languages, so words that
# are common in another sense in one of them (the German article "die") are left out.
LEXICON = {
    INSULT: "idiot idiots moron morons stupid dumb fool fools loser losers scum trash garbage pathetic worthless "
    "disgusting clown clowns filth vermin imbecile jerk coward cowards crap freak ugly useless",
    THREAT: "kill hurt destroy burn beat shoot stab crush",
    INTENT: "will gonna going shall must should deserve deserves hope "
    "werde wirst wird werden sollst soll solltest muss musst "
    "vais vas va allons allez dois devrais mérites méritez "
    "voy vas va vamos debes debería mereces merece",
    TARGET: "you your yours u ur he she they them him her his their these those people everyone "
    "du dich dir dein deine ihr euch euer eure "
    "tu toi te ton ta tes vous votre vos "
    "tú ti usted ustedes eres vosotros",
    NEGATION: "not no never isn aren wasn weren don doesn didn won can't cannot ain nobody without "
    "nicht kein keine keinen keiner keinem nie niemals niemand ohne "
    "ne n pas jamais aucun aucune sans personne "
    "nunca jamás ni sin nadie ningún ninguna tampoco",
    REPORT: "said says say wrote writes called calls quoted quote claimed claims reported told tells "
    "sagte sagt sagen schrieb schreibt nannte nennt behauptet behauptete meinte erzählte "
    "dit disait écrit écrivait appelle appelait prétend raconte "
    "dijo dice decía escribió escribe llamó llama contó afirma",
}
PRIOR_WEIGHT = {INSULT: 2.0, THREAT: 1.5}
HOLDS = 4  # words for which a negation or an intent holds
NEGATED, REPORTED, AIMED, UNMEANT = 0.0, 0.4, 1.25, 0.2

SAMPLE = 12_000  # labelled rows that weights are fitted on
LEARNED = 10_000  # learned words and stems at most
STEMS = (5, 6, 7, 8)  # letters of a stem; the word itself is longer
MIN_CONTEXTS, MIN_LOG_ODDS, MAX_WEIGHT = 5, 1.0, 6.0
CONFIDENCE = 3.29  # standard errors: 99.9 %

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[ord("a") : ord("z") + 1] = False
_SEPARATOR[0x80:] = False
_CLAUSE_END = np.zeros(256, bool)
_CLAUSE_END[[ord(c) for c in ".!?;\n"]] = True


def _hash_words(words: list[str]) -> np.ndarray:
    data = " ".join(words).encode()
    return Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), _SEPARATOR).hashes()


def stem_hashes(words: Words, letters: int) -> tuple[np.ndarray, np.ndarray]:
    """The words longer than ``letters`` and a hash of the first letters of each."""
    heads = np.flatnonzero((words.data & 0xC0) != 0x80)
    end = np.searchsorted(heads, words.starts) + letters
    ends = np.append(heads, len(words.data))[np.minimum(end, len(heads))]
    longer = np.flatnonzero(ends < words.ends)
    return longer, mix(span_hashes(words.data, words.starts[longer], ends[longer]) ^ np.uint64(letters))


@dataclass
class Grammar:
    """Symbols by word hash (sorted), their weights, insulting stems by hash (sorted) with theirs, and the
    logistic model over clause figures."""

    words: np.ndarray
    symbols: np.ndarray
    weights: np.ndarray
    stems: np.ndarray
    stem_weights: np.ndarray
    model: np.ndarray = default(default_factory=lambda: np.array([-3.0, 3.0, 0.5, 0.5, 0.0]))

    @staticmethod
    def of(learned: dict[int, float] | None = None, stems: dict[int, float] | None = None) -> Grammar:
        table: dict[int, tuple[int, float]] = {}
        for symbol, words in LEXICON.items():
            for h in _hash_words(words.split()).tolist():
                table.setdefault(h, (symbol, PRIOR_WEIGHT.get(symbol, 0.0)))
        for h, weight in (learned or {}).items():
            if table.get(h, (INSULT, 0))[0] == INSULT:
                table[h] = (INSULT, weight)
        words = np.array(sorted(table), np.uint64)
        symbols, weights = zip(*[table[w] for w in words.tolist()])
        stems = dict(sorted((stems or {}).items()))
        return Grammar(
            words, np.array(symbols), np.array(weights), np.array([*stems], np.uint64), np.array([*stems.values()], float)
        )

    def read(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Symbol (0: none) and weight of each word. A word that is known as a whole is not read by its stems."""
        hashes = words.hashes()
        found = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[found] == hashes
        symbol, weight = np.where(known, self.symbols[found], 0), np.where(known, self.weights[found], 0.0)
        for letters in STEMS if len(self.stems) else ():
            longer, stems = stem_hashes(words, letters)
            found = np.minimum(np.searchsorted(self.stems, stems), len(self.stems) - 1)
            hit = (self.stems[found] == stems) & ~known[longer]
            at = longer[hit]
            symbol[at] = INSULT
            weight[at] = np.maximum(weight[at], self.stem_weights[found[hit]])
        return symbol, weight


# --- The transducers -------------------------------------------------------------------------------
#
# Letters: 0 is a gap (a word without symbol), 1 to 6 the symbols; the same plus QUOTED inside quotation marks.

N_LETTERS, QUOTED = 14, 7


@dataclass
class Transducer:
    """``next[state, letter]``; the state is a number from 0, the state at the start of a clause."""

    next: np.ndarray

    @property
    def states(self) -> int:
        return len(self.next)

    @staticmethod
    def holding(symbol: int, words: int) -> Transducer:
        """State k: the symbol holds for k more words."""
        left = np.arange(words + 1)
        table = np.repeat(np.maximum(left - 1, 0)[:, None], N_LETTERS, axis=1)
        table[:, [symbol, symbol + QUOTED]] = words
        return Transducer(table)

    @staticmethod
    def seen(symbol: int) -> Transducer:
        """State 1 once the symbol has been read."""
        table = np.repeat(np.arange(2)[:, None], N_LETTERS, axis=1)
        table[:, [symbol, symbol + QUOTED]] = 1
        return Transducer(table)


MACHINES = {
    "negation": Transducer.holding(NEGATION, HOLDS),
    "intent": Transducer.holding(INTENT, HOLDS),
    "target": Transducer.seen(TARGET),
    "report": Transducer.seen(REPORT),
}


def factor(symbol: int, quoted: bool, negation: int, intent: int, target: int, report: int) -> float:
    """What the joint state, before the word is read, makes of the weight of an insult or threat."""
    if symbol not in (INSULT, THREAT):
        return 0.0
    out = UNMEANT if symbol == THREAT and not intent and not target else 1.0
    if negation:
        out *= NEGATED
    if report or quoted:
        out *= REPORTED
    return out


@dataclass
class Composition:
    """All machines as one: the next joint state and the factor for every state and letter, what a clause's end in a
    state adds, and the state after a number of gaps (all machines have settled after ``HOLDS`` of them)."""

    next: np.ndarray
    factor: np.ndarray
    final: np.ndarray
    gaps: np.ndarray


def compose(machines: dict[str, Transducer]) -> Composition:
    shape = [m.states for m in machines.values()]
    joint = np.stack(np.unravel_index(np.arange(int(np.prod(shape))), shape), axis=1)
    following = np.zeros((len(joint), N_LETTERS), np.int64)
    factors = np.zeros((len(joint), N_LETTERS))
    for letter in range(N_LETTERS):
        parts = [m.next[joint[:, i], letter] for i, m in enumerate(machines.values())]
        following[:, letter] = np.ravel_multi_index(parts, shape)
        for state, each in enumerate(joint.tolist()):
            factors[state, letter] = factor(letter % QUOTED, letter >= QUOTED, **dict(zip(machines, each)))
    gaps = [np.arange(len(joint))]
    for _ in range(HOLDS):
        gaps.append(following[gaps[-1], 0])
    final = np.where(joint[:, list(machines).index("target")] > 0, AIMED, 1.0)
    return Composition(following, factors, final, np.array(gaps))


COMPOSED = compose(MACHINES)
_NEXT, _FACTOR, _FINAL, _GAPS = (t.tolist() for t in (COMPOSED.next, COMPOSED.factor, COMPOSED.final, COMPOSED.gaps))


def clause_weight(symbols: list[int], weights: list[float], places: list[int], quoted: list[bool]) -> float:
    """The weight with which the composed transducers leave one clause. ``places`` are word numbers: words between
    them are gaps."""
    state, before, total = 0, places[0] - 1 if places else 0, 0.0
    for symbol, weight, place, in_quotes in zip(symbols, weights, places, quoted):
        state = _GAPS[min(place - before - 1, HOLDS)][state]
        letter = symbol + QUOTED if in_quotes else symbol
        total += weight * _FACTOR[state][letter]
        state, before = _NEXT[state][letter], place
    return total * _FINAL[state]


def clause_figures(batch: pa.RecordBatch, grammar: Grammar) -> np.ndarray:
    """Per text: 1, any match, largest clause weight, sum of clause weights (log), words (log)."""
    data, at = text_bytes(field(batch, "text"))
    words = Words(LOWER[data], at, _SEPARATOR)
    out = np.zeros((len(at) - 1, 5))
    out[:, 0] = 1
    out[:, 4] = np.log1p(words.counts)
    if not len(words):
        return out
    symbol, weight = grammar.read(words)
    read = np.flatnonzero(symbol)
    symbol, weight = symbol[read], weight[read]
    ends, quotes = np.cumsum(_CLAUSE_END[data]), np.cumsum(data == ord('"'))
    start = words.starts[read]
    text = words.text[read]
    # a clause is a text and the number of clause ends before it
    clause = ends[start] + text
    matched = np.isin(clause, np.unique(clause[symbol <= THREAT]))
    read, symbol, weight, start, text, clause = (x[matched] for x in (read, symbol, weight, start, text, clause))
    if not len(read):
        return out
    # quotation marks since the clause began
    heads = np.concatenate([[0], np.flatnonzero(_CLAUSE_END[data]) + 1])
    head = np.maximum(heads[ends[start]], at[text])
    open_quotes = (quotes[start] - quotes[head] + (data[head] == ord('"'))) % 2 == 1
    cuts = np.flatnonzero(np.concatenate([[True], clause[1:] != clause[:-1]])).tolist()
    for i, j in zip(cuts, [*cuts[1:], len(read)]):
        w = clause_weight(symbol[i:j].tolist(), weight[i:j].tolist(), read[i:j].tolist(), open_quotes[i:j].tolist())
        if w > 0:
            row = out[text[i]]
            row[1] = 1
            row[2] = max(row[2], w)
            row[3] += w
    out[:, 3] = np.log1p(out[:, 3])
    return out


def probability(figures: np.ndarray, model: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(figures @ model, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.01, *[penalty] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = probability(x, w)
        gradient = x.T @ (y - p) - ridge @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def labelled_sample(texts: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """At most ``size`` labelled rows that are not held out: doc_id, text, toxic."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    # `size` short rows: small enough for every executor. One text per doc_id, so the sample has no more rows; the
    # smallest one is found within the tasks before anything moves.
    found = texts.join(F.broadcast(chosen), "doc_id")
    return stored(found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")), "labelled-sample")


def least_log_odds(t: Column, n: Column, toxic: int, others: int) -> Column:
    """The lower end of the interval (Wilson's) of the log odds of ``t`` toxic surroundings against ``n`` others,
    less those of the sample's ``toxic`` and ``others`` rows."""
    z, m = CONFIDENCE, t + n
    half = z * F.sqrt(t * n / m + z * z / 4)
    return F.log((t + z * z / 2 - half) / (n + z * z / 2 + half)) - F.log((F.lit(toxic) + 1) / (F.lit(others) + 1))


def learned_words(sample: DataFrame) -> tuple[dict[int, float], dict[int, float]]:
    """Words and stems of toxic documents by log odds, counted by different surroundings. At most ``LEARNED`` in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = text_bytes(field(batch, "text"))
            words = Words(LOWER[data], at, _SEPARATOR)
            h = words.hashes()
            if not len(h):
                continue
            before, after = np.concatenate([h[:1], h[:-1]]), np.concatenate([h[1:], h[-1:]])
            around = mix(before ^ mix(after))
            toxic = field(batch, "toxic").to_numpy()
            for letters in (0, *STEMS):
                # 0: the words themselves
                which, units = stem_hashes(words, letters) if letters else (np.arange(len(h)), h)
                text = words.text[which]
                _, once = np.unique(mix(units ^ mix(text.astype(np.uint64))), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(units[once].view(np.int64)),
                        pa.array(np.full(len(once), letters, np.int32)),
                        pa.array(around[which[once]].view(np.int64)),
                        pa.array(toxic[text[once]]),
                    ],
                    ["unit", "letters", "around", "toxic"],
                )

    seen = sample.select("text", "toxic").mapInArrow(run, "unit long, letters int, around long, toxic int").distinct()
    counts = seen.groupBy("unit", "letters").agg(
        F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") != 1).alias("n")
    )
    totals = sample.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") != 1).alias("n")).first()
    odds = F.log((F.col("t") + 0.5) / (totals.t + 1)) - F.log((F.col("n") + 0.5) / (totals.n + 1))
    least = least_log_odds(F.col("t"), F.col("n"), totals.t, totals.n)
    best = (
        counts.where(F.col("t") >= MIN_CONTEXTS)
        .withColumns({"w": F.least(odds, F.lit(MAX_WEIGHT)), "least": least})
        .where(F.col("least") >= MIN_LOG_ODDS)
    ).orderBy(F.desc("least"), "unit").limit(LEARNED)
    words, stems = {}, {}
    for row in best.collect():
        (stems if row.letters else words)[row.unit & 0xFFFFFFFFFFFFFFFF] = row.w
    return words, stems


def learn(texts: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Grammar:
    """The grammar with learned words and a model fitted on the sample's clause figures (``size`` short rows)."""
    sample = labelled_sample(texts, labels, size)
    grammar = Grammar.of(*learned_words(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            figures = clause_figures(batch, grammar)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(figures[:, i].copy()) for i in range(5)], field(batch, "toxic")], [*"abcde", "toxic"]
            )

    rows = sample.select("text", "toxic").mapInArrow(run, "a double, b double, c double, d double, e double, toxic int")
    table = rows.toArrow()
    y = (table["toxic"].to_numpy() == 1).astype(float)
    if 0 < y.sum() < len(y):
        grammar.model = _fit(np.stack([table[c].to_numpy() for c in "abcde"], 1), y)
    return grammar


def toxic_score(text: Column, grammar: Grammar) -> Column:
    """The score as a column, for filters that keep all other columns."""

    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [probability(clause_figures(b, grammar), grammar.model) for b in slices(iter([batch]), "text")]
        return pa.array(np.concatenate([*parts, np.zeros(0)]))

    return F.arrow_udf(score, "double")(text.cast("string"))


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = texts.select("doc_id", toxic_score(F.col("text"), learn(texts, labels)).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_toxicity(spark, folder: str) -> DataFrame:
    return score_toxicity(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    )
