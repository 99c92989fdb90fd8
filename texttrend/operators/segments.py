"""An index kept up to date: segments are added, merged and deleted from without refitting the rest."""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import is_small, small_table, store
from ..sources.claims import publish_once, published
from .index import LEAST_PARTS, SearchIndex, TermIndex, _index, part_of, rare_squares, split_idf, term_counts, term_statistics, vocabulary, with_tokens

# Words of a file of postings, and documents below which a segment is merged with others.
FILE_TOKENS, SMALL_SEGMENT = 2_000_000, 1_000_000
ATTEMPTS = 20


@dataclass(frozen=True)
class Entry:
    """A segment ("add") or a set of deleted ids ("delete") in the order they were committed."""

    kind: str
    name: str


@dataclass(frozen=True)
class State:
    version: int
    entries: tuple[Entry, ...]
    id_col: str
    parts: int
    options: dict

    @property
    def segments(self) -> list[str]:
        return [e.name for e in self.entries if e.kind == "add"]

    def deletes_after(self, segment: str) -> list[str]:
        """Deletions that apply to a segment: those committed later."""
        at = self.entries.index(Entry("add", segment))
        return [e.name for e in self.entries[at + 1 :] if e.kind == "delete"]


class SegmentStore:
    """Segments below one folder, and a log of commits that says which of them count.

    Each commit is a file ``log/<version>.json`` that only one writer can
    create. A writer that comes second reads the new state and tries again, so
    additions, deletions and merges may run side by side. Folders no commit names
    (of writers that were lost) are never read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- commits

    def _log(self, version: int) -> str:
        return f"{self.path}/log/{version:012d}.json"

    def create(self, id_col: str = "doc_id", parts: int = LEAST_PARTS, **vocabulary_options) -> SegmentStore:
        """Begin an empty store; the options are those of ``fit_index`` and hold for all its searches."""
        options = {k: list(v) if k == "stop_words" and v is not None else v for k, v in vocabulary_options.items()}
        if not self._publish(State(0, (), id_col, parts, options)):
            raise ValueError(f"{self.path} holds a store already")
        return self

    def state(self) -> State:
        versions = published(self.spark, f"{self.path}/log/*.json")
        if not versions:
            raise ValueError(f"no store at {self.path}")
        kept = json.loads(self.spark.read.text(f"{self.path}/log/{versions[-1]}").first()[0])
        entries = tuple(Entry(**e) for e in kept["entries"])
        return State(kept["version"], entries, kept["id_col"], kept["parts"], kept["options"])

    def _publish(self, state: State) -> bool:
        content = {**vars(state), "entries": [vars(e) for e in state.entries]}
        return publish_once(self.spark, self._log(state.version), content)

    def _commit(self, change) -> State:
        """Publish ``change(state)`` (new entries, computed anew for every attempt) as the next version."""
        for _ in range(ATTEMPTS):
            state = self.state()
            following = State(state.version + 1, tuple(change(state)), state.id_col, state.parts, state.options)
            if self._publish(following):
                return following
        raise RuntimeError(f"{ATTEMPTS} other commits came first")

    # ---- what the segments hold

    def _read(self, kind: str, name: str, table: str) -> DataFrame:
        path = f"{self.path}/{kind}/{name}"
        if table != "postings":
            return self.spark.read.parquet(f"{path}/{table}")
        # A segment without words has no folder to tell the columns from.
        id_field = self.spark.read.parquet(f"{path}/documents").schema.fields[0]
        columns = f"`{id_field.name}` {id_field.dataType.simpleString()}, term string, tf int, length int, part int"
        return self.spark.read.schema(columns).parquet(f"{path}/postings")

    def _without(self, rows: DataFrame, state: State, segment: str) -> DataFrame:
        for name in state.deletes_after(segment):
            gone = self._read("deletes", name, "ids")
            rows = rows.join(F.broadcast(gone) if is_small(gone) else gone, state.id_col, "left_anti")
        return rows

    def _live(self, state: State, table: str, segments: list[str] | None = None) -> DataFrame | None:
        tables = [self._without(self._read("segments", s, table), state, s) for s in (state.segments if segments is None else segments)]
        return reduce(DataFrame.unionByName, tables) if tables else None

    def documents(self, state: State | None = None) -> DataFrame:
        """(id, tokens) of all documents that count."""
        state = state or self.state()
        found = self._live(state, "documents")
        if found is None:
            raise ValueError("the store holds no segment")
        return found

    def _statistics(self, state: State, segments: list[str] | None = None) -> DataFrame:
        """Counts of the segments (all of them) added up, those of deleted documents taken off: the size of the vocabulary, not of the corpus."""
        segments = state.segments if segments is None else segments
        parts = [self._read("segments", s, "statistics") for s in segments]
        for e in state.entries:
            if e.kind == "delete":
                gone = self._read("deletes", e.name, "statistics").filter(F.col("segment").isin(segments))
                parts.append(gone.select("term", (-F.col("df")).alias("df"), (-F.col("n_tokens")).alias("n_tokens")))
        both = reduce(DataFrame.unionByName, parts)
        return both.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n_tokens").alias("n_tokens")).filter("df > 0 OR term IS NULL")

    # ---- changes

    def _write_segment(self, docs: DataFrame, state: State) -> str:
        name, id_col = uuid.uuid4().hex, state.id_col
        folder = f"{self.path}/segments/{name}"
        docs = store(docs.select(id_col, "tokens"), f"{folder}/documents")
        statistics = store(term_statistics(docs), f"{folder}/statistics")
        rows = docs.repartition(self._files(statistics), id_col)
        self._write_postings(term_counts(rows, id_col).withColumn("part", part_of("term", state.parts)), folder)
        return name

    def _merge_segments(self, state: State, segments: list[str]) -> str:
        """One segment of several, without what was deleted from them; nothing is counted again."""
        name, id_col = uuid.uuid4().hex, state.id_col
        folder = f"{self.path}/segments/{name}"
        store(self._live(state, "documents", segments).select(id_col, "tokens"), f"{folder}/documents")
        statistics = store(self._statistics(state, segments), f"{folder}/statistics")
        rows = self._live(state, "postings", segments).select(id_col, "term", "tf", "length", "part")
        self._write_postings(rows.repartition(self._files(statistics), id_col), folder)
        return name

    @staticmethod
    def _files(statistics: DataFrame) -> int:
        return max(1, math.ceil((statistics.agg(F.max("n_tokens")).first()[0] or 0) / FILE_TOKENS))

    @staticmethod
    def _write_postings(rows: DataFrame, folder: str) -> None:
        rows.sortWithinPartitions("part", "term").write.mode("error").partitionBy("part").parquet(f"{folder}/postings")

    def add(self, corpus: DataFrame, text: str = "text") -> State:
        """Add articles as a segment: only they are tokenized and counted.

        Fails if an id repeats or belongs to a document that counts already, also
        if another writer added it meanwhile.
        """
        name = self._write_segment(with_tokens(corpus, text), self.state())
        checked: set[str] = set()

        def change(state: State):
            own = self._read("segments", name, "documents").select(state.id_col)
            if not checked and not own.groupBy(state.id_col).count().filter("count > 1").isEmpty():
                raise ValueError(f"{state.id_col} repeats; an index needs unique ids")
            others = self._live(state, "documents", [s for s in state.segments if s not in checked])
            if others is not None and not others.join(own, state.id_col, "left_semi").isEmpty():
                raise ValueError(f"{state.id_col} holds ids of indexed documents; delete those first")
            checked.update([name, *state.segments])
            return (*state.entries, Entry("add", name))

        return self._commit(change)

    def delete(self, ids: DataFrame) -> State:
        """Delete documents by id: they are counted once more, to be taken off the statistics; no segment is rewritten.

        Ids without a document are passed over. The ids may be added again later.
        """

        def change(state: State):
            name, id_col = uuid.uuid4().hex, state.id_col
            folder = f"{self.path}/deletes/{name}"
            gone = store(ids.select(id_col).distinct(), f"{folder}/ids")
            side = F.broadcast(gone) if is_small(gone) else gone
            counts = [
                term_statistics(self._live(state, "documents", [s]).join(side, id_col, "left_semi")).withColumn("segment", F.lit(s)) for s in state.segments
            ]
            if counts:
                store(reduce(DataFrame.unionByName, counts), f"{folder}/statistics")
            else:
                store(small_table(self.spark, [], "term string, df long, n_tokens long, segment string"), f"{folder}/statistics")
            return (*state.entries, Entry("delete", name))

        return self._commit(change)

    def compact(self, small: int = SMALL_SEGMENT) -> State:
        """Merge the segments of fewer than ``small`` documents into one, without what was deleted from them.

        Their postings and counts are read, nothing is counted again. A deletion that applies to no remaining
        segment is dropped from the log. If another writer changed one of the
        merged segments meanwhile, the merge is computed anew.
        """
        merged: dict[tuple, str] = {}

        def change(state: State):
            sizes = {s: self._read("segments", s, "documents").count() for s in state.segments}
            few = [s for s in state.segments if sizes[s] < small or state.deletes_after(s)]
            if len(few) < 2 and not any(state.deletes_after(s) for s in few):
                return state.entries
            key = tuple((s, tuple(state.deletes_after(s))) for s in few)
            if key not in merged:
                merged[key] = self._merge_segments(state, few)
            kept = [e for e in state.entries if e.name not in few]
            first = next((i for i, e in enumerate(kept) if e.kind == "add"), len(kept))
            return (*kept[first:], Entry("add", merged[key]))

        return self._commit(change)

    # ---- searches

    def load(self, norms: bool = True) -> SearchIndex:
        """The index of the newest state, for ``bm25_search`` and ``tfidf_search``.

        Statistics are merged from those of the segments. The lengths of TF-IDF
        vectors follow from all document frequencies and so change with every
        commit; they are computed from the postings when a version is first
        loaded and kept beside it. BM25 needs none: with ``norms=False`` they are
        NULL.
        """
        state = self.state()
        id_col = state.id_col
        terms = _index(self.documents(state), store(self._statistics(state)), "text", id_col)
        postings = self._live(state, "postings")
        apart = None
        if norms:
            apart = postings, self._norms(state, terms, postings)
            postings = postings.join(apart[1], id_col, "left")
        else:
            postings = postings.withColumn("norm", F.lit(None).cast("double"))
        postings = postings.select(id_col, "term", "tf", "length", "norm", "part")
        n_vocabulary = vocabulary(terms, **state.options).count()
        return SearchIndex(**vars(terms), postings=postings, parts=state.parts, options=state.options, n_vocabulary=n_vocabulary, apart=apart)

    def _norms(self, state: State, terms: TermIndex, postings: DataFrame) -> DataFrame:
        marker = f"{self.path}/norms/{state.version:012d}.json"
        if not published(self.spark, marker):
            store(self._computed_norms(state, terms, postings), f"{self.path}/norms/{(name := uuid.uuid4().hex)}")
            publish_once(self.spark, marker, {"name": name})
        name = json.loads(self.spark.read.text(marker).first()[0])["name"]
        return self.spark.read.parquet(f"{self.path}/norms/{name}")

    def _computed_norms(self, state: State, terms: TermIndex, postings: DataFrame) -> DataFrame:
        """(id, norm), added up where the postings are read; of a large vocabulary only the rare terms' postings are shuffled."""
        id_col, w = state.id_col, F.col("tf") * F.col("idf")
        own = postings.select(id_col, "term", "tf")
        frequent, rare = split_idf(terms, **state.options)
        squares = own.join(F.broadcast(frequent), "term").select(id_col, (w * w).alias("_square"))
        if rare is not None:
            others = own.join(F.broadcast(frequent.select("term")), "term", "left_anti")
            squares = squares.unionByName(rare_squares(others, rare, id_col).withColumnRenamed("_rare", "_square"))
        return squares.groupBy(id_col).agg(F.sqrt(F.sum("_square")).alias("norm")).filter("norm IS NOT NULL")
