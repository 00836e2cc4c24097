"""Resolving company names to legal entity identifiers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..sources.keys import last_id, numbered
from ..sources.schemas import REGISTRY_RECORD
from ..sources.staging import small_side, staged

TIERS = {"high": 0, "medium": 1, "low": 2, "rejected": 3}
HITS_PER_QUERY = 5
MATCH = ["lei", "lei_legal_name", "lei_country", "lei_confidence", "lei_flag_reason", "lei_review_status"]


def unseen(seed: DataFrame, companies: DataFrame) -> DataFrame:
    """Seed rows whose name no company has yet; repeats within the seed all stay."""
    return seed.join(companies.select("name"), "name", "left_anti").select(*seed.columns)


def lacking_lei(companies: DataFrame) -> DataFrame:
    return companies.where(F.col("lei").isNull())


def queries_for(companies: DataFrame) -> DataFrame:
    """company_id, name, query_no, query: what to ask the registry."""
    return companies.select(F.col("id").alias("company_id"), "name", F.posexplode(t.query_variants(F.col("name"))).alias("query_no", "query"))


def flatten_registry(records: DataFrame, json_col: str = "record") -> DataFrame:
    """Registry records as JSON to lei, legal_name, country; other columns stay."""
    parsed = records.withColumn("_r", F.from_json(json_col, REGISTRY_RECORD))
    entity = F.col("_r.attributes.entity")
    blank = F.lit("")
    return parsed.withColumns(
        {
            "lei": F.col("_r.id"),
            "legal_name": F.coalesce(entity["legalName"]["name"], blank),
            "country": F.coalesce(F.nullif(entity["legalAddress"]["country"], blank), F.nullif(entity["headquartersAddress"]["country"], blank), blank),
        }
    ).drop("_r", json_col)


def active_hits(hits: DataFrame, most: int = HITS_PER_QUERY) -> DataFrame:
    """Active entities only, and of each query the first ``most`` of them."""
    w = Window.partitionBy("company_id", "query_no").orderBy("pos")
    return hits.where("status = 'ACTIVE'").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def first_per_lei(candidates: DataFrame) -> DataFrame:
    """One candidate per company and LEI: the first by query and hit; null LEIs are one."""
    w = Window.partitionBy("company_id", "lei").orderBy("query_no", "pos")
    return candidates.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def tier_of(similarity: Column, country_ok: Column) -> Column:
    return F.when(~country_ok, "rejected").when(similarity >= 0.5, "high").when(similarity >= 0.3, "medium").otherwise("low")


def flag_reason_of(similarity: Column, country_ok: Column, searched: Column, found: Column, country: Column) -> Column:
    low = F.when(
        similarity < 0.5,
        F.concat(F.lit("Low name similarity ("), t.percent_text(similarity), F.lit("): searched '"), searched, F.lit("', found '"), found, F.lit("'")),
    )
    abroad = F.when(~country_ok, F.concat(F.lit("Country '"), F.coalesce(country, F.lit("")), F.lit("' not in expected list for FTSE 100")))
    return F.nullif(F.concat_ws("; ", low, abroad), F.lit(""))


def scored(candidates: DataFrame, own_words: Column | None = None, found_words: Column | None = None) -> DataFrame:
    """Adds similarity (of the original name), country_ok, confidence and flag_reason."""
    a = t.significant_words(F.col("search_name")) if own_words is None else own_words
    b = t.significant_words(F.col("legal_name")) if found_words is None else found_words
    out = candidates.withColumns({"similarity": t.set_similarity(a, b), "country_ok": t.country_allowed(F.col("country"))})
    s, ok = F.col("similarity"), F.col("country_ok")
    return out.withColumns({"confidence": tier_of(s, ok), "flag_reason": flag_reason_of(s, ok, F.col("search_name"), F.col("legal_name"), F.col("country"))})


def best_match(rated: DataFrame) -> DataFrame:
    """Per company its best candidate by tier, similarity and order; none if the best is
    rejected."""
    tier = F.element_at(F.create_map(*[F.lit(x) for kv in TIERS.items() for x in kv]), F.col("confidence"))
    w = Window.partitionBy("company_id").orderBy(tier, F.col("similarity").desc(), "query_no", "pos", "lei")
    return rated.withColumn("_n", F.row_number().over(w)).where("_n = 1 and confidence <> 'rejected'").drop("_n")


def resolve(candidates: DataFrame) -> DataFrame:
    """Given candidates to one match per company that has one."""
    return best_match(scored(first_per_lei(candidates)))


@dataclass
class NameIndex:
    """Names as sorted arrays of word codes, the rarest word first; stored, so it is built once.

    ``words``: word, code; ``names``: lei, codes, n. Codes are dense and ordered by how often a word
    occurs, so a name's first codes are its rarest words, and a name is a few whole numbers."""

    words: DataFrame
    names: DataFrame

    def coded(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``key``, codes, n of other names. Words that the index lacks have no code, as no name of
        the index can share them, but count in ``n``."""
        split = rows.select(key, t.significant_words(F.col(name)).alias("w"))
        known = split.select(key, F.explode("w").alias("word")).join(small_side(self.words), "word")  # a frequent word is no hot key
        codes = known.groupBy(key).agg(F.array_sort(F.collect_list("code")).alias("codes"))
        return split.select(key, F.size("w").alias("n")).join(codes, key)

    def extended(self, entities: DataFrame) -> NameIndex:
        """The index with more entities (lei, legal_name). New words get codes after all others:
        the order by rarity then holds within each delivery, which costs time, never a match."""
        fresh = _word_counts(entities, "legal_name").join(self.words, "word", "left_anti")
        added = numbered(fresh, ["n", "word"], last_id(self.words, "code"), "code").select("word", "code")
        words = staged(self.words.unionByName(added), "name-words")
        more = NameIndex(words, self.names)
        return NameIndex(words, staged(self.names.unionByName(more.coded(entities, "lei", "legal_name").select("lei", "codes", "n")), "name-codes"))


def _word_counts(rows: DataFrame, name: str) -> DataFrame:
    words = rows.select(F.explode(t.significant_words(F.col(name))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def name_index(entities: DataFrame) -> NameIndex:
    """The index of the names of entities (lei, legal_name)."""
    words = staged(numbered(_word_counts(entities, "legal_name"), ["n", "word"], id_col="code").select("word", "code"), "name-words")
    empty = NameIndex(words, entities)
    return NameIndex(words, staged(empty.coded(entities, "lei", "legal_name").select("lei", "codes", "n"), "name-codes"))


def _best_of_share(own: DataFrame, theirs: DataFrame, tenths: int) -> DataFrame:
    """key and best (similarity, lei) of companies that have an entity of so many tenths.

    Two names of that similarity share one of the rarest codes of both, as at least so many
    tenths of the longer one's words are common: all but that many (and one) are compared. The
    sizes of the names and the places of the shared code say how many words can be common at
    most, so few pairs come to be counted, on arrays of whole numbers."""
    needed = lambda n: F.greatest(F.floor((tenths * n + 9) / 10), F.lit(1))
    rarest = F.slice("codes", F.lit(1), F.greatest(F.col("n") - needed(F.col("n")).cast("int") + 1, F.lit(0)))
    side = lambda df, key, x: df.select(F.col(key), F.col("codes").alias(f"codes_{x}"), F.col("n").alias(f"n_{x}"), F.posexplode(rarest).alias(f"at_{x}", "code"))
    met = side(own, "key", "a").join(side(theirs, "lei", "b"), "code")
    left = lambda x: F.size(f"codes_{x}") - F.col(f"at_{x}")
    most = F.least(left("a"), left("b")) + F.least("at_a", "at_b")
    met = met.where(most >= needed(F.greatest("n_a", "n_b")))
    similarity = F.size(F.array_intersect("codes_a", "codes_b")) / F.greatest("n_a", "n_b")
    pairs = met.select("key", "lei", similarity.alias("similarity")).where((F.col("similarity") > 0) & (F.col("similarity") >= tenths / 10))
    return pairs.groupBy("key").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "lei")).alias("best"))


def resolve_by_registry(companies: DataFrame, registry: DataFrame, index: NameIndex | None = None) -> DataFrame:
    """One match per company that has one, from a whole registry: of the active entities in an
    allowed country with a common significant word the one of the best tier and similarity; ties
    go to the lowest LEI, as there is no order of hits. ``index``: that of those entities, if it
    is stored already.

    Tiers are tried from the best, each for the companies still open and by the rarest words
    that its similarity leaves, so frequent words join nothing but the names that have little
    else. A pair carries codes and ids; names are joined to the matches alone."""
    entities = registry.where("status = 'ACTIVE'").where(t.country_allowed(F.col("country")))
    index = index or name_index(entities)
    own = staged(index.coded(companies.select("id", "name"), "id", "name"), "company-codes")
    # names of the same words are one: it is searched once, and stands for its lowest LEI
    theirs = staged(index.names.groupBy("codes", "n").agg(F.min("lei").alias("lei")), "distinct-codes")
    same = F.struct("codes", "n").alias("key")
    open_, found = own.select("codes", "n", same).distinct(), []
    for tenths in (5, 3, 0):
        found.append(staged(_best_of_share(open_, theirs, tenths), "registry-matches"))
        open_ = staged(open_.join(found[-1].select("key"), "key", "left_anti"), "open-names")
        if open_.isEmpty():
            break
    best = reduce(DataFrame.unionByName, found).select("key.codes", "key.n", "best.lei")
    matched = own.join(best, ["codes", "n"]).select(F.col("id").alias("company_id"), "lei")
    searched = companies.select(F.col("id").alias("company_id"), F.col("name").alias("search_name"))
    hits = searched.join(matched, "company_id").join(entities.select("lei", "legal_name", "country"), "lei")
    return scored(hits.withColumns({"query_no": F.lit(0), "pos": F.lit(0)}))


def match_columns(matches: DataFrame) -> DataFrame:
    """Matches under the names that the companies table has, with the first review status."""
    return matches.select(
        "company_id",
        "lei",
        F.col("legal_name").alias("lei_legal_name"),
        F.col("country").alias("lei_country"),
        F.col("confidence").alias("lei_confidence"),
        F.col("flag_reason").alias("lei_flag_reason"),
        first_review_status(F.col("confidence")).alias("lei_review_status"),
    )


def first_review_status(confidence: Column) -> Column:
    return F.when(confidence == "high", "approved").otherwise("pending")


def backfill(companies: DataFrame, matches: DataFrame) -> DataFrame:
    """Fills the LEI columns of companies that have none and got a match."""
    m = match_columns(matches).select(F.col("company_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in MATCH])
    both = companies.join(m, F.col("id") == F.col("_id"), "left")
    fill = F.col("lei").isNull() & F.col("_lei").isNotNull()
    return both.select(*[(F.when(fill, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in MATCH else F.col(c)) for c in companies.columns])


def new_companies(seed: DataFrame, companies: DataFrame, matches: DataFrame, index_membership: str) -> DataFrame:
    """Rows to add: unseen seed companies (with ids) and what was found for them."""
    fresh = unseen(seed, companies)
    m = match_columns(matches).withColumnRenamed("company_id", "id")
    return fresh.join(m, "id", "left").withColumns({"lei_review_status": F.coalesce("lei_review_status", F.lit("pending")), "index_membership": F.lit(index_membership)})
