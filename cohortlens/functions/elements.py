"""Elements of markup with what is nested in them, by one fold over tags.

The markup is cut before every tag of the kinds asked for, and the fold carries the
elements that are open. So an element ends at its own end tag, not at the first
one inside, and the text of a nested element belongs to all around it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TAG = r"(?is)^</?[a-z][^\s>/]*[^>]*>"


def first_element(markup: Column, tag: str, opening: str) -> Column:
    """What lies inside the first element whose open tag matches `opening`; null if there is none.

    An element that is never closed ends with the markup.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, piece: Column) -> Column:
        depth, opens, closes = state["depth"], piece.rlike(rf"(?i)^<{tag}\b"), piece.rlike(rf"(?i)^</{tag}\b")
        enters = (depth == 0) & ~state["done"] & opens & piece.rlike("^" + opening)
        after = F.when(enters, 1).when((depth > 0) & opens, depth + 1).when((depth > 0) & closes, depth - 1).otherwise(depth)
        seen = F.when(enters, F.regexp_replace(piece, _TAG, "")).when((depth > 0) & (after > 0), piece)
        return F.struct(
            after.cast("int").alias("depth"), (state["done"] | ((depth > 0) & (after == 0))).alias("done"),
            F.when(seen.isNotNull(), F.concat(state["out"], F.array(seen))).otherwise(state["out"]).alias("out"),
        )

    pieces = F.split(markup, rf"(?i)(?=</?{tag}\b)")
    return F.aggregate(pieces, start, step, lambda s: F.when(F.size(s["out"]) > 0, F.array_join(s["out"], "")))


def list_items(markup: Column, root: str, opening: str, kinds: tuple[str, ...]) -> Column:
    """(tag, level, live, text) of the items in the first list whose open tag matches `opening`, in order.

    Items of lists inside an item are items too, of a higher level. An item
    ends at its end tag, at the next item of its own list, or with the list.
    """
    tags = "|".join((root, *kinds))
    start = F.struct(
        F.lit(0).alias("depth"), F.lit(False).alias("done"),
        F.array().cast("array<struct<tag:string,level:int,live:boolean,text:string>>").alias("items"),
    )

    def step(state: Column, piece: Column) -> Column:
        depth, name = state["depth"], F.lower(F.regexp_extract(piece, rf"(?i)^</?({tags})\b", 1))
        closes, inside = piece.startswith("</"), depth > 0
        list_opens, list_closes = (name == root) & ~closes, (name == root) & closes & inside
        enters = list_opens & ~inside & ~state["done"] & piece.rlike("^" + opening)
        begins = inside & ~closes & name.isin(*kinds)
        after = F.when(enters, 1).when(list_opens & inside, depth + 1).when(list_closes, depth - 1).otherwise(depth)

        def carry(item: Column) -> Column:
            own = item["level"] == depth
            ends = (list_closes & (item["level"] >= depth)) | (begins & own) | (inside & closes & (name == item["tag"]) & own)
            live = item["live"] & ~ends
            return F.struct(
                item["tag"].alias("tag"), item["level"].alias("level"), live.alias("live"),
                F.when(live, F.concat(item["text"], piece)).otherwise(item["text"]).alias("text"),
            )

        carried = F.transform(state["items"], carry)
        new = F.struct(
            name.alias("tag"), depth.cast("int").alias("level"), F.lit(True).alias("live"), F.regexp_replace(piece, _TAG, "").alias("text")
        )
        return F.struct(
            after.cast("int").alias("depth"), (state["done"] | (list_closes & (after == 0))).alias("done"),
            F.when(begins, F.concat(carried, F.array(new))).otherwise(carried).alias("items"),
        )

    pieces = F.split(markup, rf"(?i)(?=</?(?:{tags})\b)")
    return F.aggregate(pieces, start, step, lambda s: s["items"])
