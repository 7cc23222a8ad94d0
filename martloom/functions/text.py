"""Name, e-mail, region and null-normalising expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.schema import NAME_PARTICLES, STATE_REGIONS

# Unicode white space plus the four ASCII separators.
_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def normalize_name(name: Column) -> Column:
    """Lower case with everything outside a-z deleted (accented letters are not folded)."""
    return F.regexp_replace(F.lower(name), "[^a-z]", "")


def customer_email(full_name: Column) -> Column:
    """``first.last@example.com`` of a name without particles; one part stands alone.

    A null or blank name, or one made only of particles, gives null.
    """
    words = F.split(F.trim(F.regexp_replace(full_name, _BLANKS, " ")), " ")
    parts = F.filter(words, lambda w: (w != "") & ~F.lower(w).isin(*NAME_PARTICLES))

    def local(parts: Column) -> Column:
        first, last = normalize_name(F.get(parts, F.lit(0))), normalize_name(F.try_element_at(parts, F.lit(-1)))
        return F.when(F.size(parts) == 1, first).when(F.size(parts) > 1, F.concat(first, F.lit("."), last))

    # the one-element array makes the parts a lambda variable, so that they are worked out once
    return F.concat(F.get(F.transform(F.array(parts), local), F.lit(0)), F.lit("@example.com"))


def store_email(store_name: Column) -> Column:
    """``contato@slug.com.br``; null when nothing is left of the name."""
    slug = F.btrim(F.regexp_replace(F.lower(store_name), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(slug != "", F.concat(F.lit("contato@"), slug, F.lit(".com.br")))


def region_of(state: Column) -> Column:
    """Region of a state code; unknown codes give null."""
    pairs = [F.lit(x) for pair in STATE_REGIONS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), state)


def split_list(text: Column) -> Column:
    """``;``-separated cell to array."""
    return F.split(text, ";")


def nan_to_null(number: Column, to: str = "bigint") -> Column:
    """Float keys read from nullable integer columns: NaN becomes null."""
    return F.when(~F.isnan(number), number).cast(to)
