"""Unnesting of nested investment documents into the flat investments feed.

An account's document holds its transactions as an array of structs of texts. ``inline``
gives a row for each element (none for an empty or missing array), and the columns and
types of the feed follow from its schema: a leaf of the document of the same name, the
account of the document, and for the id the document's name of it. Texts that are no
number become NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.schemas import INVESTMENTS

# Columns that the documents call otherwise.
NAME_IN_DOCUMENT = {"id": "transaction_id"}


def unnest_investments(nested: DataFrame) -> DataFrame:
    rows = nested.select("account_id", F.inline("transactions"))
    return rows.select(
        *[F.col(NAME_IN_DOCUMENT.get(f.name, f.name)).try_cast(f.dataType).alias(f.name) for f in INVESTMENTS.fields]
    )
