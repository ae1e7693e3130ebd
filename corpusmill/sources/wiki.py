"""A source of documents from tables of wiki pages and category members."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.credibility import CREDIBILITY_MAP
from ..operators.dedup import shared
from ..operators.graph import walk_pages
from ..plans.ingest import pages_to_documents


@dataclass
class WikiSource:
    """Documents of the pages that a walk from the seed categories yields.

    config has category_depth, max_articles_per_category, max_articles_per_language, seed_categories and languages.
    The cap on documents is the smaller of max_docs and the language's, and counts documents, not pages.
    """

    pages: DataFrame
    members: DataFrame
    config: dict
    language: str = "ar"
    max_docs: int | None = 100
    entries: tuple = field(default=CREDIBILITY_MAP)

    def cap(self) -> int | None:
        most = self.config.get("max_articles_per_language")
        return self.max_docs if not most else int(most) if self.max_docs is None else min(self.max_docs, int(most))

    def candidates(self, most: int | None) -> DataFrame:
        """The first `most` pages of the walk."""
        seeds = list((self.config.get("seed_categories") or {}).get(self.language) or [])
        return walk_pages(self.pages, self.members, seeds, int(self.config.get("category_depth", 1)), int(self.config.get("max_articles_per_category", 100)), most, self.language)

    def collect(self) -> tuple[DataFrame, DataFrame]:
        """(documents, rejections (key, reason))."""
        docs, rejected = self.walked()
        return docs, rejected.drop("ingest_seq")

    def walked(self) -> tuple[DataFrame, DataFrame]:
        """(documents, rejections (ingest_seq, key, reason)), whose ingest_seq is the place in the walk.

        Pages that are empty after cleaning do not count towards the cap: while too few documents come out and the walk
        has more pages, it is taken twice as far. Rejections after the last document are not reached and not reported.
        """
        cap = most = self.cap()
        while True:
            walk = self.candidates(most)
            found = self.pages.join(walk if cap is None else F.broadcast(walk), "title")  # at most `most` titles
            docs, rejected = pages_to_documents(found, self.config, self.language, self.entries)
            if cap is None:
                return docs, rejected
            docs = shared(docs, "collected")
            if docs.count() >= cap or walk.count() < most:
                break
            most *= 2
        docs = docs.orderBy("ingest_seq").limit(cap)
        reached = docs.agg(F.count("*").alias("n"), F.max("ingest_seq").alias("last")).first()
        return docs, rejected if reached.n < cap else rejected.where(F.col("ingest_seq") < F.lit(reached.last))

    def read(self, spark: SparkSession) -> DataFrame:
        return self.collect()[0]
