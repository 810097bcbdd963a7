"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the classes of a clause's words: insult, threat, target, negation and reported speech.
They are composed into one machine whose states are tuples of theirs; a clause's weight is that of its final state
plus the weights of the insults passed on the way, damped where a negation or a reporting verb rules the clause. A
document's score is the logistic of the prior and its clauses' weights. Clauses without an insult or a threat weigh
nothing, so an automaton over the lexicon's stems finds the few clauses that need reading.

The insult lexicon is learnt: words and beginnings of words that mark documents labelled toxic, tested against the
number of stems tried, and seen after several different words, so that copies of one document teach nothing. Learning
takes at most LEARN_ROWS labelled rows, the first by a hash of doc_id; every other step reads all documents. Rows with
crc32(doc_id) mod 4 = 2 are never learnt from.

Cases: null and empty texts score the prior. Rows without doc_id and repeated rows are scored each on its own; rows
without doc_id are not held out. Labels that are null or have no document are ignored; of several labels of a document
the largest counts. Without labels the lexicon is empty. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.session import apply_settings

LEARN_ROWS = 20_000
LEARN_TASKS = 12
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
STEMS = (3, 4, 5, 6, 8)  # letters of the beginnings tried, beside whole words
PURITY = 0.9  # least share of toxic documents among those with a stem

# weights of the grammar
TARGETED = 1.0  # an insult or threat in a clause that names a person
THREAT = 5.0  # intent, then harm, to a person
DAMPED = 0.25  # share of an insult's weight left under negation or reported speech
MOST_PRIOR = math.log(0.2 / 0.8)

# word classes of the closed-class transducers
TARGETS = frozenset("you your yourself he she they them him her du dich dir ihr euch tu te toi vous usted ustedes ellos ella".split())
NEGATIONS = frozenset("not no never without nicht kein keine keinen nie pas jamais aucun nunca ningún ninguna".split())
REPORTS = frozenset(
    "said says say wrote writes called calls quoted quotes claimed sagte sagt nannte schrieb zitierte "
    "dit disait écrit appelé dijo dice escribió llamó".split()
)
INTENTS = frozenset("will shall gonna going must should werde wirst werden vais va allez voy vas".split())
HARMS = frozenset("kill hurt beat die burn shoot stab töten umbringen sterben tuer mourir frapper matar morir".split())

_CLAUSE_END = frozenset(b".!?;:\n")
_TABLE = bytes(46 if b in _CLAUSE_END else (b if common.ALNUM[b] else 32) for b in range(256))
_MARKS = re.compile("[ -⁯ -¿　-〃]")


def folded(text: str) -> str:
    """Words between single spaces, clauses between dots that stand alone."""
    text = text.lower()
    if not text.isascii():
        text = _MARKS.sub(" ", text)
    line = text.encode().translate(_TABLE).replace(b".", b" . ")
    return f" {b' '.join(line.split()).decode()} "


# --- the grammar -----------------------------------------------------------------------------------------------

OTHER, INSULT, INTENT, HARM, TARGET, NEGATION, REPORT = range(7)

# each transducer: state -> {class: next state}; classes not named keep the state
TRANSDUCERS = {
    "insult": {0: {INSULT: 1}, 1: {}},
    "threat": {0: {INTENT: 1}, 1: {HARM: 2}, 2: {}},
    "target": {0: {TARGET: 1}, 1: {}},
    "negation": {0: {NEGATION: 1}, 1: {INSULT: 2, HARM: 2}, 2: {}},  # only in front of what it negates
    "reported": {0: {REPORT: 1}, 1: {}},
}


def composed() -> dict[tuple[int, ...], list[tuple[int, ...]]]:
    """The product machine: for each tuple of states, the tuple after each word class."""
    tables = list(TRANSDUCERS.values())
    return {
        state: [tuple(t[s].get(symbol, s) for t, s in zip(tables, state)) for symbol in range(7)]
        for state in product(*tables)
    }


MACHINE = composed()
START = (0,) * len(TRANSDUCERS)


def final_weight(state: tuple[int, ...], insults: float) -> float:
    """Weight of a clause that ends in a state after insults of this weight."""
    insult, threat, target, negation, reported = state
    weight = insults if insult else 0.0
    if threat == 2 and target:
        weight += THREAT
    if not weight:
        return 0.0
    if target:
        weight += TARGETED
    if negation == 2:
        weight *= DAMPED
    if reported:
        weight *= DAMPED
    return weight


@dataclass
class Lexicon:
    """Weighted stems (``word$`` for whole words) and the prior of a document."""

    stems: dict[str, float]
    prior: float
    _whole: dict[str, float] = field(init=False, repr=False)
    _starts: dict[int, dict[str, float]] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self._whole = {s[:-1]: w for s, w in self.stems.items() if s.endswith("$")}
        self._starts = {}
        for stem, weight in self.stems.items():
            if not stem.endswith("$"):
                self._starts.setdefault(len(stem), {})[stem] = weight

    def insult(self, word: str) -> float:
        """Weight of a word as an insult, 0 for none."""
        best = self._whole.get(word, 0.0)
        for n, stems in self._starts.items():
            best = max(best, stems.get(word[:n], 0.0))
        return best

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for stem in self.stems:
            found.add_word(f" {stem[:-1]} " if stem.endswith("$") else f" {stem}", 1)
        for word in HARMS:
            found.add_word(f" {word} ", 1)
        found.make_automaton()
        return found

    def clause_weight(self, words: list[str]) -> float:
        state, insults = START, 0.0
        for word in words:
            weight = self.insult(word)
            if weight:
                symbol, insults = INSULT, insults + weight
            elif word in HARMS:
                symbol = HARM
            elif word in TARGETS:
                symbol = TARGET
            elif word in NEGATIONS:
                symbol = NEGATION
            elif word in REPORTS:
                symbol = REPORT
            elif word in INTENTS:
                symbol = INTENT
            else:
                continue
            state = MACHINE[state][symbol]
        return final_weight(state, insults)

    def clauses(self, text: str, found: ahocorasick.Automaton) -> list[tuple[str, float]]:
        """The clauses that hold an insult or a threat, with their weights."""
        line = folded(text)
        out, done = [], 0
        for end, _ in found.iter(line):
            if end <= done:
                continue
            first = line.rfind(" . ", 0, end) + 1
            done = line.find(" . ", end)
            done = len(line) if done < 0 else done
            clause = line[first:done].strip(" .")
            weight = self.clause_weight(clause.split())
            if weight:
                out.append((clause, weight))
        return out

    def score(self, text: str | None, found: ahocorasick.Automaton) -> float:
        total = self.prior + sum(weight for _, weight in self.clauses(text, found)) if text else self.prior
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


# --- learning --------------------------------------------------------------------------------------------------


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _stems(words: set[str]) -> set[str]:
    out = {f"{w}$" for w in words}
    for n in STEMS:
        out.update(w[:n] for w in words if len(w) > n)
    return out


def _stem_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of toxic and other documents with each stem."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (toxic if label else clean).update(_stems({w for w in folded(text).split() if w != "."}))
    names = list(toxic | clean)
    if names:
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([toxic[n] for n in names], pa.int64()), pa.array([clean[n] for n in names], pa.int64())],
            names=["stem", "toxic", "clean"],
        )


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Text and label of at most ``rows`` documents to learn from."""
    named = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    chosen = named.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")  # the broadcast has at most `rows` rows


def _tail(toxic: int, clean: int, rate: float) -> float:
    """Log of a bound on the chance that so many of a stem's documents are toxic by accident."""
    n = toxic + clean
    share = toxic / n
    if share <= rate:
        return 0.0
    rest = (1 - share) * math.log((1 - share) / (1 - rate)) if share < 1 else 0.0
    return -n * (share * math.log(share / rate) + rest)


def _families(stems: dict[str, tuple[int, int]]) -> dict[str, tuple[int, int]]:
    """One stem for each family: the longest that still has nearly all its documents."""

    def within(long: str, short: str) -> bool:
        return long != short and not short.endswith("$") and long.startswith(short)

    names = sorted(stems)
    keep = []
    for name in names:
        longer = [s for s in names[names.index(name) + 1 :] if within(s, name)]
        if not any(stems[s][0] >= 0.95 * stems[name][0] for s in longer):
            keep.append(name)
    return {s: stems[s] for s in keep if not any(within(s, t) for t in keep)}


def learn(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> Lexicon:
    """The lexicon of a bounded sample of labelled rows; only tested stems reach the driver."""
    sample = common.kept(_sample(docs, labels, rows).repartition(LEARN_TASKS))
    n_toxic, n = sample.agg(F.sum("toxic"), F.count("*")).first()
    if not n_toxic or n_toxic == n:
        return Lexicon({}, MOST_PRIOR)
    counts = sample.mapInArrow(_stem_batches, "stem string, toxic long, clean long").groupBy("stem")
    counts = common.kept(counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    rate, tried = n_toxic / n, counts.count()
    pure = counts.where((F.col("toxic") >= 3) & (F.col("toxic") >= PURITY * (F.col("toxic") + F.col("clean"))))
    least = -math.log(tried) - 1
    tested = {r["stem"]: (r["toxic"], r["clean"]) for r in pure.toLocalIterator() if _tail(r["toxic"], r["clean"], rate) <= least}
    spread = _spread(sample, frozenset(tested))
    stems = {s: c for s, c in tested.items() if spread.get(s, 0) >= max(3, 0.5 * c[0])}
    weights = {
        s: math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n - n_toxic + 1)) for s, (t, c) in _families(stems).items()
    }
    return Lexicon(weights, min(MOST_PRIOR, math.log(rate / (1 - rate))))


def _spread(sample: DataFrame, stems: frozenset[str]) -> dict[str, int]:
    """After how many different words each stem is seen in toxic documents."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                before = ""
                for word in folded(text).split():
                    seen.update((s, before) for s in _stems({word}) & stems)
                    before = word
        if seen:
            a, b = zip(*seen)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["stem", "before"])

    pairs = sample.where("toxic = 1").select("text").mapInArrow(contexts, "stem string, before string").distinct()
    return {r[0]: r[1] for r in pairs.groupBy("stem").count().toLocalIterator()}


# --- scoring ---------------------------------------------------------------------------------------------------


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of ``docs`` with a column ``_score``."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = lexicon.automaton()
        for texts in batches:
            yield pa.array((lexicon.score(t.as_py(), found) for t in texts), pa.float64())

    return docs.withColumn("_score", score("text"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = scored(docs.select("doc_id", "text"), learn(docs, labels))
    return rows.select(
        "doc_id", held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, learn_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted toxic, with their own columns."""
    rows, given = common.set_apart(docs, ["text"])
    return scored(rows, learn(learn_docs, labels)).where(F.col("_score") < THRESHOLD).select(*given)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return report(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
