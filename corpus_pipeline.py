"""The training-data pipeline over documents: what is toxic, repeated or leaked goes, the rest is encoded.

Null texts count as empty and are equal to these: one row of them stays, by the second stage. Rows with a null id are
judged by their text as others are. Texts of any length are taken whole. Repeated rows go with the
copies. Other columns, whatever their names, come through all stages but the last. An empty table, or one without labels,
gives what its rows give: no labels, no toxic texts.
"""

from __future__ import annotations

from martbrook.llm import bpe, decontaminate, exact_dedup, jaccard, toxicity
from martbrook.llm.queries import vocabulary
from martbrook.llm.texts import table
from martbrook.session import written

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def without_toxic(spark, docs, sf_dir):
    """Documents that the classifier, trained on the labelled ones, does not call toxic. Equal texts are judged alike;
    where labels of both kinds are missing, all stay, but for labels that are all toxic, when none does."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark, docs, sf_dir):
    """Of documents with equal texts the one with the largest id; null and empty texts are equal."""
    return exact_dedup.deduplicated(docs)


def without_near_copies(spark, docs, sf_dir):
    """Of documents connected by near-duplicate links the one with the least id. Shingles are five
    words, and a link takes a similarity of 0.8. Texts without a word have no links."""
    return jaccard.one_of_each(docs, jaccard.Join(words=5, percent=80))


def without_benchmark(spark, docs, sf_dir):
    """Documents without a passage of the benchmark; those without a word have none."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def as_tokens(spark, docs, sf_dir):
    """Token ids of every document, and digests of them and of what they decode to; none of an empty text."""
    return bpe.token_digests(bpe.encode(docs, vocabulary(spark), decoded=True), "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", as_tokens),
]


def run(spark, sf_dir):
    """All stages over ``documents``, each result written to the shared folder and read again, so that a lost
    executor costs its tasks of one stage only."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
