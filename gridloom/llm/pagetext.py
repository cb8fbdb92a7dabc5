"""Main text of web pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import htmlmodel, htmltree

#: Pages whose trees are one forest.
FOREST_PAGES = 400


def extract_text(pages: DataFrame, model: htmlmodel.Model | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars`` to ``pages``, from column html.

    The blocks of all nodes that the model holds for content, in page order, one to a
    line; inside a block references are decoded and white space is one space.  ``model``
    is the one trained on generated labelled pages unless another is given.

    A null or empty page has an empty text; one without tags is a page of one block.  Columns
    named text or n_chars are replaced, all others pass through.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or htmlmodel.trained())

    @F.pandas_udf("string")
    def extract(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for html in parts:
            out: list[str] = []
            for at in range(0, len(html), FOREST_PAGES):
                trees = [htmltree.parse(h or "") for h in html.iloc[at:at + FOREST_PAGES]]
                for tree, p in zip(trees, own.content(trees)):
                    bare = len(tree.tag) == 1
                    out.append("\n".join(text for node, text in tree.runs if bare or p[node] >= 0.5))
            yield pd.Series(out, index=html.index, dtype=object)

    out = pages.drop("text", "n_chars").withColumn("text", extract(F.col("html")))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op7(pages: DataFrame) -> DataFrame:
    return extract_text(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
