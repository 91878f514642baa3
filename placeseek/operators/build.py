"""The whole way from stored pages to the post table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.operators import extract, gazetteer
from placeseek.sizing import localised
from placeseek.sources.store import first_per_key


def placed_posts(pages: DataFrame, names: DataFrame) -> DataFrame:
    """Posts of all readable pages that name a known place, one per page address.

    Places are found, and repeated addresses dropped, on titles and addresses alone;
    bodies meet only the rows that stay, in one join.
    """
    names, _ = localised(names)
    posts = extract.extracted(pages)
    keys = ["page_id", "page_url"]
    found = gazetteer.place_names(posts.select(*keys, "page_title", "page_description"), names, keys)
    located = gazetteer.placed_only(gazetteer.with_coordinates(found, names))
    kept = first_per_key(located, order="page_id").drop("page_url")
    return posts.join(kept, "page_id").select(
        F.col("page_id").cast("long").alias("id"),
        "blog_url", "page_url", "page_title", "page_description", "page_author",
        "location_name", "latitude", "longitude", "content",
    )
