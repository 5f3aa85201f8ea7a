"""HTML main text by gradient-boosted trees over DOM nodes.

Every block element (and inline element with a class, id or role) is a node with
features of its subtree density, attribute words, depth and siblings. Boosted trees,
fitted by Spark ML on a bounded number of invented labelled pages, tell how likely it
holds article text. Decoding picks the best set of nodes in which the ancestors of a
kept node are kept: what stands in a dropped element is dropped.

Defined cases: NULL and empty pages have an empty text; pages without elements are
text throughout; broken markup is read leniently, an unclosed script to the end of
the page; equal rows get equal results; extra columns do not matter.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.llm.common import slices
from gridledger.llm.html_dom import Page
from gridledger.llm.html_training import MARK, training_pages

#: Bound of the training sample.
TRAINING_PAGES = 400
TREES = 16
DEPTH = 5
#: Nodes scored at a time.
NODES = 20_000
#: Largest say of one node in the decoding.
MOST = 6.0


def training_rows(pages=TRAINING_PAGES, seed=0):
    """Features and label (holds article text) of the nodes with text."""
    features, labels = [], []
    for html in training_pages(pages, seed):
        page = Page(html)
        holds = np.zeros(len(page.tag), bool)
        runs = []
        for node, block, text, in_link in page.runs:
            holds[node] |= MARK in text
            runs.append((node, block, text.replace(MARK, ""), in_link))
        page.runs = runs
        for i in range(len(holds) - 1, 0, -1):
            holds[page.parent[i]] |= holds[i]
        rows = page.features()
        with_text = rows[:, 1] > 0
        with_text[0] = False
        features.append(rows[with_text])
        labels.append(holds[with_text])
    return np.concatenate(features), np.concatenate(labels)


def train(spark, pages=TRAINING_PAGES, seed=0):
    """The fitted trees as arrays: see ``_arrays``."""
    features, labels = training_rows(pages, seed)
    width = features.shape[1]
    table = pa.table(
        {
            "f": pa.FixedSizeListArray.from_arrays(pa.array(features.ravel().astype(float)), width)
            .cast(pa.list_(pa.float64())),
            "label": pa.array(labels.astype(float)),
        }
    )
    rows = spark.createDataFrame(table).coalesce(2)
    model = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.4,
        maxBins=64, seed=1,
    ).fit(rows.select(array_to_vector("f").alias("features"), "label"))
    return _arrays(model.toDebugString)


def _arrays(text):
    """Trees of a model's description: per tree its weight and, per node, feature (-1:
    leaf), threshold, children and value."""
    trees = []
    for part in re.split(r"\n\s*Tree \d+ ", text)[1:]:
        weight = float(re.match(r"\(weight ([^)]*)\)", part)[1])
        lines = [x.strip() for x in part.split("\n")[1:] if x.strip()]
        feature, threshold, left, right, value = [], [], [], [], []

        def node(at):
            me = len(feature)
            for column in (feature, threshold, left, right, value):
                column.append(0)
            leaf = re.match(r"Predict: (\S+)", lines[at])
            if leaf:
                feature[me], value[me] = -1, float(leaf[1])
                left[me] = right[me] = me
                return at + 1
            test = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at])
            feature[me], threshold[me] = int(test[1]), float(test[2])
            left[me] = len(feature)
            at = node(at + 1)
            right[me] = len(feature)
            return node(at + 1)  # past the Else line

        node(0)
        trees.append((weight, *map(np.array, (feature, threshold, left, right, value))))
    return trees


def scores(trees, features):
    """Log-odds per row."""
    rows = np.arange(len(features))
    total = np.zeros(len(features))
    for weight, feature, threshold, left, right, value in trees:
        at = np.zeros(len(features), int)
        while True:
            split = feature[at] >= 0
            if not split.any():
                break
            goes_left = features[rows, np.maximum(feature[at], 0)] <= threshold[at]
            at = np.where(split, np.where(goes_left, left[at], right[at]), at)
        total += weight * value[at]
    return np.clip(2 * total, -MOST, MOST)


def main_texts(htmls, trees):
    """Main text of each page."""
    out, pages, rows = [], [], 0

    def flush():
        found = scores(trees, np.concatenate([f for _, f in pages])) if pages else []
        at = 0
        for page, features in pages:
            score = found[at : at + len(features)]
            at += len(features)
            out.append(page.text(page.decode(score)))
        pages.clear()

    for html in htmls:
        page = Page(html or "")
        features = page.features()
        pages.append((page, features))
        rows += len(features)
        if rows >= NODES:
            flush()
            rows = 0
    flush()
    return out


def extract(pages, trees):
    """page_id, url, text, n_chars of every row."""
    pages = common.with_columns(pages, {"page_id": "bigint", "url": "string", "html": "string"})
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            texts = main_texts(batch.column("html").to_pylist(), trees)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars bigint"
    )
