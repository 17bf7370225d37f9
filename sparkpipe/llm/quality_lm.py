"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model.

Documents get the perplexity of their whole text under the word model of ``word_lm``, which
is trained on all trusted text (labelled good), and go when it lies above a quantile of the
trusted documents of their language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small_side
from . import word_lm
from .common import free_name, lean, materialise

#: Words of average text that are added to a document, so that a few words prove nothing.
PRIOR_WORDS = 8
#: Quantile of the trusted perplexities of a language, and the slack on it: none.
QUANTILE, SLACK = 0.995, 1.0
#: One of so many trusted documents is held out to set the thresholds; the threshold of all
#: languages weighs as much in a language's own as OWN_DOCUMENTS of its held-out documents.
HELD_OUT, OWN_DOCUMENTS = 5, 50
#: Ids of trusted documents are broadcast up to so many rows; beyond, the tables are joined.
TRUSTED_ROWS = 2_000_000


def marked_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                     good: str = "quality", rows: int = TRUSTED_ROWS) -> tuple[DataFrame, str]:
    """The documents with a further column, not null if the labels call them good; its name.

    Null ids and null labels trust nothing.
    """
    name = free_name(docs, "__trusted")
    ids = labels.where(F.col(good) == 1).select(F.col(id_col).cast("long").alias(name)).distinct()
    return docs.join(small_side(ids, rows), F.col(id_col).cast("long") == F.col(name), "left"), name


def perplexity(average, prior: int = PRIOR_WORDS):
    """Column: perplexity a word, with ``prior`` words of average text added."""
    return F.exp((F.col("__nll") + F.lit(prior) * average) / (F.col("__n_words") + F.lit(prior)))


def held_out(id_col: str = "doc_id"):
    """Column: whether a trusted document is held out to set the thresholds."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit(11)), F.lit(HELD_OUT)) == 0


def thresholds(scored: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> tuple[DataFrame, float, float]:
    """lang, threshold: by language; the threshold of all languages; average nats a word.

    A document that the model was trained on looks better than an unseen one; so ``scored``
    are the documents held out, by the model of the others.
    """
    sums = scored.agg(F.sum("__nll"), F.sum("__n_words")).first()
    average = float(sums[0] / sums[1]) if sums[1] else 0.0
    ppl = scored.select(F.col("__lang").alias("lang"), perplexity(F.lit(average)).alias("ppl"))
    limit = F.percentile_approx("ppl", quantile, 10_000) * slack
    overall = ppl.agg(limit).first()[0]
    overall = float("inf") if overall is None else overall
    own = ppl.groupBy("lang").agg(limit.alias("own"), F.count("*").alias("n"))
    blend = (F.col("n") * F.col("own") + F.lit(OWN_DOCUMENTS * overall)) / (F.col("n") + F.lit(OWN_DOCUMENTS))
    return own.select("lang", blend.alias("threshold")), overall, average


def _judged(docs: DataFrame, labels: DataFrame, columns: list, id_col: str, text_col: str, lang_col: str,
            good: str, quantile: float, slack: float) -> DataFrame:
    """row (``columns`` in a struct, so that no name clashes), perplexity, threshold, keep."""
    marked, name = marked_documents(docs, labels, id_col, good)
    trusted, held = F.col(name).isNotNull(), held_out(id_col)
    model = word_lm.train(marked, held, text_col, trusted)
    found = word_lm.score(docs, marked.where(trusted & held), model, [
        F.struct(*columns).alias("row"), F.col(lang_col).cast("string").alias("__lang")], text_col, known=True)
    with lean(docs.sparkSession):
        scored = materialise(found, "scores")
    model.release()
    limits, overall, average = thresholds(scored.where("__held"), quantile, slack)
    limits = small_side(limits.select(F.col("lang").alias("__of"), F.col("threshold").alias("__own")))
    found = scored.where("not __held").join(limits, F.col("__lang") == F.col("__of"), "left").select(
        "row", "__n_words", perplexity(F.lit(average)).alias("perplexity"), F.coalesce(F.col("__own"), F.lit(overall)).alias("threshold"))
    return found.select("row", "perplexity", "threshold",
                        ((F.col("perplexity") <= F.col("threshold")) | (F.col("__n_words") == 0)).alias("keep"))


def classify(docs: DataFrame, labels: DataFrame, columns: list | None = None, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", good: str = "quality",
             quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """``columns`` of docs (all by default) with __perplexity, __threshold and __keep.

    Null text is empty; an empty text says nothing and is kept.  A language without trusted
    documents (or null) takes the threshold of all; without any trusted text held out
    everything is kept.  Repeated rows get the same answer; ties with the threshold are kept.
    A text of any length is scored whole.  Other columns may have any name but the three.
    """
    columns = docs.columns if columns is None else columns
    judged = _judged(docs, labels, [F.col(f"`{c}`") for c in columns], id_col, text_col, lang_col, good, quantile, slack)
    return judged.select(*(F.col(f"row.`{c}`").alias(c) for c in columns),
                         *(F.col(c).alias(f"__{c}") for c in ("perplexity", "threshold", "keep")))


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   good: str = "quality", quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """The documents that the classifier keeps, with their own columns, whatever their names."""
    names = [free_name(docs, f"__{x}_of_text") for x in "abc"]
    key = [*word_lm.text_key(text_col), F.col(lang_col).cast("string")]
    judged = _judged(docs, labels, [c.alias(name) for c, name in zip(key, names, strict=True)], id_col, text_col, lang_col, good, quantile, slack)
    # what goes is told by its text and language, so that no text is written or moved
    gone = small_side(materialise(judged.where("not keep").select("row.*").distinct(), "rejected"))
    same = [c.eqNullSafe(F.col(name)) for c, name in zip(key, names, strict=True)]
    return docs.join(gone, same[0] & same[1] & same[2], "left_anti")
