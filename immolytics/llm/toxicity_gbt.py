"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features are lexicon densities (a fixed list of insults and words learned from
the labelled sample), hits near second-person words, capitals, punctuation and
obfuscation rates. Spark ML fits the trees and the calibration on a bounded,
hashed sample of labelled documents, on separate parts of it; every document is
scored from its whole text.

Defined cases: null and empty texts have all features 0; without both labels in
the sample every score is the share of toxic labels (0 without labels);
repeated rows get equal scores; an empty table gives an empty result; input
columns named like a result are replaced by it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .common import Memo, append_columns, labelled_sample

# Labelled documents that lexicon, trees and calibration are fitted on, at most.
FIT_DOCUMENTS = 12_288
TREES = 20
DEPTH = 3
THRESHOLD = 0.5
# Words between a hit and a second-person word that still count as near.
NEAR = 6
# A learned word occurs in at least so many toxic documents of the sample, so many times as often as in others.
LEAST_DOCUMENTS = 6
LEAST_RATIO = 8.0
LEARNED_WORDS = 2000

# Insults, and second-person words of some languages.
INSULTS = """
arse arsehole ass asshole bastard bitch bloody bollocks brainless clown cockroach coward creep cretin crook cunt
damn degenerate dickhead dimwit dirtbag disgusting douche dumb dumbass dunce embarrassment failure fool fraud freak
fuck fucker fucking garbage gross hate hideous hypocrite idiot idiotic ignorant imbecile inbred incompetent inferior
jackass jerk kill laughable liar loser lowlife lunatic maggot moron moronic motherfucker nasty nitwit numbskull
parasite pathetic pig pervert piss prick psycho putrid rat repulsive retard retarded rotten rubbish scum scumbag shit
shitty shut sick sicko simpleton slimy slut snake stink stupid suck sucks swine thick thug trash troll twat twit ugly
useless vermin vile waste weasel whore wimp worthless wretched
abruti connard connasse con débile imbécile merde minable ordure pourriture raclure salaud salope stupide
abschaum arschloch blödmann dreck dummkopf hurensohn idiotisch miststück schwachkopf schwein trottel versager wichser
basura cabrón cobarde estúpido gilipollas hijoputa imbécil inútil maldito mierda patético payaso perra puta tonto
""".split()
SECOND_PERSON = """
you your yours yourself yourselves u ur ya youre tu te toi ton ta tes vous votre vos du dich dir dein deine deinen ihr
euch euer eure usted ustedes ti tuyo vosotros vuestro
""".split()
# Characters that stand for letters in obfuscated words.
LOOKALIKES = str.maketrans("013457@$!|+€", "oieastasiite")

_EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’…-–—*#%&|/\\_~`^=+$@"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_RUNS = re.compile(rb"[!?]{2,}|\.{3,}")
_ALL = bytes(range(256))
_UPPER = bytes(set(_ALL) - set(range(65, 91)))
_LETTERS = bytes(set(_ALL) - set(range(65, 91)) - set(range(97, 123)) - set(range(128, 256)))
_MARKS = bytes(set(_ALL) - set(b"#*$%&|<>@^~"))
N_FEATURES = 16


@dataclass(frozen=True)
class Lexicon:
    """Fixed insults and learned words with their weights (log ratio of document shares)."""
    learned: dict[str, float] = field(default_factory=dict)


def plain(word: bytes) -> str:
    return word.decode("utf-8", "replace").lower().strip(_EDGES)


def unmasked(word: bytes) -> str:
    """A word with look-alikes replaced, inner marks dropped and long repeats shortened."""
    text = word.decode("utf-8", "replace").lower().strip(".,;:?\"'()")
    text = "".join(c for c in text.translate(LOOKALIKES) if c.isalpha())
    return re.sub(r"(.)\1{2,}", r"\1", text)


def make_features(lexicon: Lexicon):
    """Task function: one list of ``N_FEATURES`` numbers per text."""
    insults, second = frozenset(INSULTS), frozenset(SECOND_PERSON)

    def classify(word: bytes) -> tuple[int, float, int, int] | None:
        """(insult, learned weight, second person, obfuscated) of a word, None for an ordinary one."""
        text = plain(word)
        insult, weight, person = text in insults, lexicon.learned.get(text, 0.0), text in second
        hidden = 0
        if not insult and not text.isalpha() and any(c.isalpha() for c in text):
            bare = unmasked(word)
            hidden = int(bare != text and bare in insults)
        found = (int(insult or hidden), weight, int(person), hidden)
        return found if any(found) else None

    kinds = Memo(classify)

    def features(texts: list[bytes | None]) -> list[list[float]]:
        out = []
        for raw in texts:
            raw = raw or b""
            words = raw.split()
            n, size = len(words), max(1, len(raw))
            counts = Counter(words)
            marked = {w: k for w in counts if (k := kinds[w])}
            insults_n = sum(counts[w] for w, k in marked.items() if k[0])
            learned = [(k[1], counts[w]) for w, k in marked.items() if k[1] > 0]
            hidden = sum(counts[w] for w, k in marked.items() if k[3])
            people = sum(counts[w] for w, k in marked.items() if k[2])
            near = 0
            if people and (insults_n or learned):
                at_hit = [i for i, w in enumerate(words) if w in marked and (marked[w][0] or marked[w][1] > 0)]
                at_person = np.asarray([i for i, w in enumerate(words) if w in marked and marked[w][2]])
                place = np.searchsorted(at_person, at_hit)
                after = np.abs(at_person[np.minimum(place, len(at_person) - 1)] - at_hit)
                before = np.abs(at_person[np.maximum(place - 1, 0)] - at_hit)
                near = int((np.minimum(before, after) <= NEAR).sum())
            letters, upper = len(raw.translate(None, _LETTERS)), len(raw.translate(None, _UPPER))
            per_word, learned_n = 1000 / max(1, n), sum(c for _, c in learned)
            out.append([
                math.log1p(insults_n), insults_n * per_word, float(len([1 for k in marked.values() if k[0]])),
                math.log1p(learned_n), learned_n * per_word, max((w for w, _ in learned), default=0.0),
                sum(w * c for w, c in learned) * per_word, near * per_word, people * per_word,
                upper / max(1, letters), raw.count(b"!") * 1000 / size, raw.count(b"?") * 1000 / size,
                len(_RUNS.findall(raw)) * 1000 / size, hidden * per_word,
                len(raw.translate(None, _MARKS)) * 1000 / size, math.log1p(n)])
        return out
    return features


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Words over-represented in toxic documents of ``sample`` (text, __label), by document frequency.

    Counted per task, added up in a shuffle; at most ``LEARNED_WORDS`` rows reach the driver.
    """
    def make():
        def compute(texts):
            return [[sorted({p for w in set((t or b"").split()) if (p := plain(w)) and len(p) <= 40}) for t in texts]]
        return compute

    words = append_columns(sample, [("words", T.ArrayType(T.StringType()))], make, keep=("__label",))
    sizes = {r["__label"]: r.n for r in sample.groupBy("__label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    by_word = (words.select("__label", F.explode("words").alias("word")).groupBy("word")
               .agg(F.count_if(F.col("__label") == 1).alias("t"), F.count_if(F.col("__label") == 0).alias("c")))
    ratio = ((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("c") + 0.5) / (clean + 1))
    top = (by_word.where((F.col("t") >= LEAST_DOCUMENTS) & (ratio >= LEAST_RATIO))
           .select("word", F.log(ratio).alias("weight"), "t").orderBy(F.desc("t"), "word").limit(LEARNED_WORDS))
    return Lexicon({r.word: r.weight for r in top.collect()})


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float


def _with_features(docs: DataFrame, lexicon: Lexicon, keep) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        features = make_features(shared.value)
        return lambda texts: [features(texts)]
    return append_columns(docs, [("__features", T.ArrayType(T.DoubleType()))], make, keep=keep)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", documents: int = FIT_DOCUMENTS,
                 folds: int = 5) -> ToxicityModel:
    """Fit on at most ``documents`` labelled rows whose fold (crc32 of doc_id) is not 0.

    A hashed quarter of them is left out of lexicon and trees and used to calibrate.
    """
    sample = materialize(labelled_sample(docs, labels, label, documents, folds), "toxicity-sample")
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4))
    for_trees, for_calibration = sample.where(part != 0), sample.where(part == 0)
    sizes = {(r.k, r.y): r.n for r in sample.groupBy((part != 0).alias("k"), F.col("__label").alias("y"))
             .agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    share = sum(n for (_, y), n in sizes.items() if y == 1) / max(1, total)
    if any(not sizes.get((k, y)) for k in (True, False) for y in (0, 1)):
        return ToxicityModel(Lexicon(), None, None, share)
    lexicon = learn_lexicon(for_trees)
    rows = materialize(_with_features(sample, lexicon, ("doc_id", "__label")), "toxicity-features")
    ready = rows.select(array_to_vector("__features").alias("features"), F.col("__label").cast("double").alias("label"),
                        (part != 0).alias("trees"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5, minInstancesPerNode=5,
                          cacheNodeIds=False).fit(ready.where("trees"))
    margins = trees.transform(ready.where("NOT trees")).select(
        "label", vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(margins.withColumn("weight", F.lit(1.0)))
    return ToxicityModel(lexicon, trees, calibration, share)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with score (calibrated probability) and predicted (score >= threshold)."""
    kept = [c for c in dict.fromkeys(keep) if c not in ("score", "predicted")]
    if model.trees is None:
        scored = docs.select(*kept, F.lit(model.share).alias("score"))
    else:
        raw = model.trees.transform(_with_features(docs, model.lexicon, kept)
                                    .withColumn("__vector", array_to_vector("__features")),
                                    {model.trees.featuresCol: "__vector", model.trees.predictionCol: "__p",
                                     model.trees.rawPredictionCol: "__m", model.trees.probabilityCol: "__q"})
        calibrated = model.calibration.transform(raw.withColumn("__raw", vector_to_array("__q")[1]),
                                                 {model.calibration.featuresCol: "__raw",
                                                  model.calibration.predictionCol: "__score"})
        scored = calibrated.select(*kept, F.least(F.greatest("__score", F.lit(0.0)), F.lit(1.0)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
