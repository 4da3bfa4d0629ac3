"""Access to nested resource fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dig(path: str, root: Column | None = None) -> Column:
    """Follow ``a.b[].c``: dots step into structs, ``[]`` takes the first array element.

    Missing structs, empty arrays and NULLs all give NULL, also with ANSI mode on.
    """
    col = root
    for step in path.split("."):
        name = step.removesuffix("[]")
        col = F.col(name) if col is None else col.getField(name)
        if step.endswith("[]"):
            col = F.get(col, F.lit(0))
    return col


def strip_prefix(ref: Column, resource: str) -> Column:
    """``Patient/x`` -> ``x``; any other form is left as it is."""
    return F.regexp_replace(ref, f"^{resource}/", "")


def remove_text(col: Column, text: str) -> Column:
    """Remove every occurrence of a literal text."""
    return F.replace(col, F.lit(text), F.lit(""))
