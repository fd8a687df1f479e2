"""String measures and name cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(c: Column, acronyms: tuple[str, ...] = ("FMCG",)) -> Column:
    """Trim, then title-case word by word while keeping listed acronyms in capitals.

    ``initcap`` is not used: it would write ``Fmcg``, and it also recases letters after digits.
    Splitting on a single space keeps empty words, so a double inner space survives (the check
    for clean names catches it).
    """
    upper_set = F.array(*[F.lit(a) for a in acronyms])

    def word(w: Column) -> Column:
        return F.when(F.array_contains(upper_set, F.upper(w)), F.upper(w)).otherwise(
            F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))))

    return F.array_join(F.transform(F.split(F.trim(c), " "), word), " ")


def item_label(sku: Column, city: Column) -> Column:
    """``sku, city`` label of a product at a warehouse."""
    return F.concat_ws(", ", sku.cast("string"), city)
