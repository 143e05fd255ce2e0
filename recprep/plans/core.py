"""The shape all interaction datasets share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.operators.keyed import best_row
from recprep.operators.ordered import with_position
from recprep.session import discard, materialize, release

CUSTOMER, PRODUCT = "customer_id", "product_id"


def interaction_dataset(
    interactions: DataFrame,
    sides: list[tuple],
    columns: list[Column],
    keys: list[str] = (CUSTOMER, PRODUCT),
    best: list[Column] | None = None,
    ordered: list[Column] | None = None,
    name: str | None = "i",
    derived: dict[str, Column] | None = None,
    position_of: list[str] | None = None,
    read: tuple[DataFrame, ...] | None = None,
    needs: tuple[str, ...] = (),
    store_rows: bool = True,
) -> DataFrame:
    """Join dimension tables to interactions and project one row per key.

    ``sides`` holds (table, join keys, how, and a name for ``columns`` if any). Every side has one row per join key, so the joins
    never multiply rows and a hot customer is split by the adaptive skew join. ``best`` picks
    the row to keep when interactions hold several per key; it runs before the joins, so only
    kept rows are widened. ``columns`` may call the interactions by ``name``. ``ordered`` lays the
    rows out in that global order, in parallel, and adds ``position``, the place in it from 1; with
    ``position_of`` only these columns are laid out and returned. ``derived`` columns come from the joined
    row, so no shuffle carries them.

    With ``read``, tables stored for this dataset alone, the work goes in steps: the rows (unless ``store_rows`` is
    off) and each side are stored one after the other and the shuffle files of a step are dropped before the next, so
    that disk holds one step's files and narrow tables, not all at once. ``read`` is deleted when all are stored,
    or, where rows still read it, after the layout. Where ``position_of`` is given only the join keys and the columns
    ``needs`` are stored: all that its columns come from.
    """
    rows = interactions if best is None else best_row(interactions, list(keys), best)
    stored: list[DataFrame] = []
    staged = read is not None
    if staged:
        only = {*keys, *needs} if ordered and position_of else None
        if store_rows:
            rows = _stored(rows, only, stored)
        sides = [(_stored(table, only, stored), *rest) for table, *rest in sides]
        if store_rows:
            discard(*read)
    if name is not None:
        rows = rows.alias(name)
    for table, on, how, *label in sides:
        rows = rows.join(table.alias(label[0]) if label else table, on, how)
    out = (rows.withColumns(derived) if derived else rows).select(*columns)
    if ordered and position_of:
        out = out.select(*position_of)
    out = with_position(out, ordered) if ordered else out
    if staged and ordered:  # what was laid out is stored
        discard(*stored, *read)
    return out


def _stored(table: DataFrame, only: set[str] | None, stored: list[DataFrame]) -> DataFrame:
    """The table, stored; columns not in ``only`` are not stored and read as null. Shuffle files are dropped."""
    left_out = {f.name: F.lit(None).cast(f.dataType) for f in table.schema if only is not None and f.name not in only}
    stored.append(materialize(table.drop(*left_out)))
    release(table.sparkSession)
    return stored[-1].withColumns(left_out) if left_out else stored[-1]
