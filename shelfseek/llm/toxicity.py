"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding undoes disguises: letters of other scripts that look Latin, accents, full-width forms, digits and symbols that
stand for letters inside words. The lexicon is learned from a bounded sample of labelled rows (``MAX_LABELLED``): words
and word beginnings that occur in clearly more toxic texts than clean ones, weighted by log-odds. Phrases around an entry
that occur mostly in clean texts become exceptions, which silence the entry inside them. A text's matched weight,
by its number of words and as such, is turned into a probability by a logistic fit on the same sample.

Every row is scored in Arrow batches, without a shuffle; the model has at most ``MAX_ENTRIES`` entries.

Defined results: null, empty and wordless texts have no match and get the probability of a text without any; rows with a
null label, null ids and ids in conflict over their label (the larger one counts) do not stop the fit; without rows of both
classes nothing is toxic. Ids, languages and sources are no inputs.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfseek.llm.text_arrays import Shared, batch_map

#: At most so many labelled rows are learned from, taken by the hash of their id.
MAX_LABELLED = 20_000
MAX_ENTRIES = 5_000
FOLDS = 5
STEMS = range(4, 9)
#: An entry occurs in so many toxic texts at least, however many there are ...
MIN_TEXTS = 5
#: ... and its log-odds are at least this.
MIN_WEIGHT = 2.0

# Letters of other scripts that look like Latin ones, and what digits and symbols stand for.
LOOKALIKES = {
    "а": "a", "в": "b", "г": "r", "е": "e", "з": "e", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "п": "n",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ь": "b", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ϲ": "c", "ı": "i", "ɑ": "a", "ɡ": "g",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "l": "i", "j": "i"}
INSIDE = {"@": "a", "$": "s", "!": "i", "|": "i"}
SYMBOL_INSIDE = re.compile(r"(?<=[a-z0-9])[@$!|]+(?=[a-z0-9])")


def beyond_ascii() -> dict[int, str]:
    """What characters beyond ASCII fold to: their base letter, a Latin letter they look like, nothing for marks and
    invisible characters, a space for what is no letter or digit."""
    table = {}
    for code in [*range(0x80, 0x3000), *range(0xFF00, 0xFFF0)]:
        char = chr(code)
        kind = unicodedata.category(char)
        base = unicodedata.normalize("NFKD", char.lower())[:1]
        if kind in ("Mn", "Cf"):
            table[code] = ""
        elif kind[0] not in "LN":
            table[code] = " "
        elif base in LOOKALIKES:
            table[code] = LOOKALIKES[base]
        elif base.isascii() and base != char:
            table[code] = base if base.isalnum() else " "
    table[ord("ß")] = "ss"
    return table


BEYOND_ASCII = beyond_ascii()
WITHIN_ASCII = bytes(
    b if b >= 0x80 else ord(STANDS_FOR.get(chr(b), chr(b) if chr(b).isalnum() else " ")) for b in range(256)
)


def fold(text: str) -> str:
    """The text's folded words, a space before and after each."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(BEYOND_ASCII)
    text = SYMBOL_INSIDE.sub(lambda m: "".join(INSIDE[c] for c in m[0]), text)
    words = text.encode("utf-8", "replace").translate(WITHIN_ASCII).decode().split()
    return f" {' '.join(words)} " if words else " "


def fold_of(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def entries_of(folded: str) -> set[str]:
    """The words of a text and their beginnings, as the automaton looks for them."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in STEMS if len(w) > k}


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, ...] = (-4.0, 0.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), None))
        if len(machine):
            machine.make_automaton()
        return machine


def matches(machine: ahocorasick.Automaton, folded: str) -> dict[int, float]:
    """Weight of the heaviest entry at each matched word, by where the word begins, but for words in exceptions."""
    found: dict[int, float] = {}
    if not len(machine):
        return found
    silent = []
    for end, (size, weight) in machine.iter(folded):
        start = end - size + 1
        if weight is None:
            silent.append((start, end))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    for a, b in silent:
        for start in [s for s in found if a <= s < b]:
            del found[start]
    return found


def features(machine: ahocorasick.Automaton, texts: list[str | None]) -> np.ndarray:
    """Per text: matched weight, matched weight per square root of its words, whether anything matched."""
    made = np.zeros((len(texts), 3))
    for k, text in enumerate(texts):
        folded = fold(text or "")
        weight = sum(matches(machine, folded).values())
        if weight:
            made[k] = (np.log1p(weight), weight / np.sqrt(folded.count(" ")), 1.0)
    return made


def probabilities(lexicon: Lexicon, made: np.ndarray) -> np.ndarray:
    start, *slopes = lexicon.coefficients
    return 1 / (1 + np.exp(-np.clip(start + made @ np.array(slopes), -30, 30)))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, limit: int
) -> DataFrame:
    """Text and label of at most ``limit`` labelled rows, those whose ids hash lowest."""
    own = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label"))
    own = own.filter("_id IS NOT NULL AND label IS NOT NULL").groupBy("_id").agg(F.max("label").alias("label"))
    sample = own.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    texts = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # At most ``limit`` ids and labels: small whatever the corpus.
    return texts.join(F.broadcast(sample), "_id").select("text", "label")


def counted(texts: DataFrame, pick) -> DataFrame:
    """(entry, clean, toxic): in how many texts of each label what ``pick`` finds in a folded text occurs."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        counts = (Counter(), Counter())
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
            counts[label > 0].update(pick(fold(text)))
        entries = list(counts[0].keys() | counts[1].keys())
        return pa.table(
            {
                "entry": pa.array(entries, pa.string()),
                "clean": pa.array([counts[0][e] for e in entries], pa.int64()),
                "toxic": pa.array([counts[1][e] for e in entries], pa.int64()),
            }
        )

    made = batch_map(texts, work, "entry string, clean bigint, toxic bigint")
    return made.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    limit: int = MAX_LABELLED,
) -> Lexicon:
    """The lexicon, its exceptions and the logistic fit, from a bounded sample of labelled rows."""
    context = docs.sparkSession.sparkContext
    texts = labelled_texts(docs, labels, doc_id, text, label, limit).persist()
    try:
        sizes = {row["label"] > 0: row["n"] for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
        toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
        if not toxic or not clean:
            return Lexicon()
        # The sample is bounded, and so are the entries found in MIN_TEXTS of its texts.
        top = counted(texts.filter("label > 0"), entries_of).filter(F.col("toxic") >= MIN_TEXTS).collect()
        candidates = Shared(context, frozenset(row["entry"] for row in top))
        against = {
            row["entry"]: row["clean"]
            for row in counted(texts.filter("label <= 0"), lambda folded: entries_of(folded) & candidates.value).collect()
        }
        weights = chosen({row["entry"]: (row["toxic"], against.get(row["entry"], 0)) for row in top}, toxic, clean)
        lexicon = Lexicon(weights)
        lexicon.exceptions = exceptions(texts, lexicon, toxic, clean)
        lexicon.coefficients = calibrated(texts, lexicon)
        return lexicon
    finally:
        texts.unpersist()


def chosen(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Weights of the entries to keep. A longer one is kept beside its beginning only if it says clearly more."""
    weights: dict[str, float] = {}
    for entry in sorted(counts, key=lambda e: (len(e), e)):
        t, c = counts[entry]
        weight = float(np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1)))
        if weight >= MIN_WEIGHT:
            shorter = max((weights.get(entry[:k], 0.0) for k in range(1, len(entry))), default=0.0)
            if weight > shorter + 1.0:
                weights[entry] = weight
    return dict(sorted(weights.items(), key=lambda x: (-x[1], x[0]))[:MAX_ENTRIES])


def phrases(machine: ahocorasick.Automaton, folded: str) -> set[str]:
    """Each matched word with the word before it, and with the one after it."""
    found = set()
    for start in matches(machine, folded):
        end = folded.index(" ", start + 1)
        before = folded.rfind(" ", 0, start)
        after = folded.find(" ", end + 1)
        if before >= 0:
            found.add(folded[before : end + 1])
        if after > 0:
            found.add(folded[start : after + 1])
    return found


def exceptions(texts: DataFrame, lexicon: Lexicon, toxic: int, clean: int) -> tuple[str, ...]:
    shared = Shared(texts.sparkSession.sparkContext, lexicon)
    machines: list = []

    def pick(folded: str) -> set[str]:
        if not machines:
            machines.append(shared.value.automaton())
        return phrases(machines[0], folded)

    found = counted(texts, pick).filter(F.col("clean") >= MIN_TEXTS)
    rows = found.orderBy(F.desc("clean"), "entry").limit(MAX_ENTRIES).collect()
    return tuple(r["entry"] for r in rows if (r["clean"] + 0.5) / (clean + 1) > (r["toxic"] + 0.5) / (toxic + 1))


def calibrated(texts: DataFrame, lexicon: Lexicon) -> tuple[float, ...]:
    """Logistic regression of the label on the sample's features, by Newton steps with a weak pull to 0."""
    shared = Shared(texts.sparkSession.sparkContext, lexicon)

    def work(batch: pa.RecordBatch) -> pa.Table:
        made = features(shared.value.automaton(), batch["text"].to_pylist())
        return pa.table({"a": made[:, 0], "b": made[:, 1], "c": made[:, 2], "label": batch["label"]})

    rows = batch_map(texts, work, "a double, b double, c double, label int").orderBy("a", "b", "c", "label").toArrow()
    x = np.column_stack([np.ones(rows.num_rows), *(rows[c].to_numpy() for c in "abc")])
    y = (rows["label"].to_numpy() > 0).astype(float)
    pull = np.diag([1e-3, 0.1, 0.1, 0.1])
    beta = np.zeros(4)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + pull
        step = np.linalg.solve(hessian, x.T @ (y - p) - pull @ beta)
        beta = beta + np.clip(step, -5, 5)
    return tuple(float(b) for b in beta)


def scoring(shared: Shared, text: str):
    """A function of a batch that gives its texts' probabilities."""
    machines: list = []

    def score(batch: pa.RecordBatch) -> np.ndarray:
        if not machines:
            machines.append(shared.value.automaton())
        return probabilities(shared.value, features(machines[0], batch[text].to_pylist()))

    return score


def score_texts(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``."""
    score = scoring(Shared(docs.sparkSession.sparkContext, lexicon), "text")

    def work(batch: pa.RecordBatch) -> pa.Table:
        found = score(batch)
        predicted = pa.array((found >= 0.5).astype(np.int32))
        return pa.table({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": found, "predicted": predicted})

    given = docs.select(
        F.col(doc_id).alias("doc_id"), (fold_of(F.col(doc_id)) == 0).alias("held_out"), F.col(text).cast("string").alias("text")
    )
    kind = docs.schema[doc_id].dataType.simpleString()
    return batch_map(given, work, f"doc_id {kind}, held_out boolean, score double, predicted int")


def clean_texts(docs: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    score = scoring(Shared(docs.sparkSession.sparkContext, lexicon), text)
    return batch_map(docs, lambda batch: pa.table(batch).filter(pa.array(score(batch) < threshold)), docs.schema, text)


def training_labels(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Labels that may be learned from; the others are for measuring."""
    return labels.filter(fold_of(F.col(doc_id)) != 0)


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_texts(docs, learn(docs, training_labels(labels)))
