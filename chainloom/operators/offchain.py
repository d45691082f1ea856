"""Off-chain documents: what is to be fetched, verification, and rows of the parsed JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETRIES, QUEUE = 3, 100


def unfetched(refs: DataFrame, fetched: DataFrame, errors: DataFrame, key: str, most_retries: int = RETRIES, limit: int = QUEUE) -> DataFrame:
    """References without data whose failures are few enough, in the order of the key.

    Failures are summed up for each reference first, so that several of them do not repeat it.
    """
    failed = errors.groupBy(key).agg(F.max("retry_count").alias("retry_count"))
    open_ = refs.join(fetched.select(key), key, "left_anti").join(failed, key, "left").where(F.coalesce("retry_count", F.lit(0)) < most_retries)
    return open_.withColumn("retry_count", F.coalesce("retry_count", F.lit(0))).orderBy(key).limit(limit)


def verified(bodies: DataFrame, body: str, expected: str, hash_: Column | None = None) -> DataFrame:
    """``bodies`` with ``valid``: whether the content hash (SHA-256 unless given) is the expected one."""
    found = F.sha2(F.col(body), 256) if hash_ is None else hash_
    return bodies.withColumn("valid", F.coalesce(F.lower(found) == F.lower(F.col(expected)), F.lit(False)))


_PERSON = "array<struct<name:string,witness:struct<publicKey:string,signature:string>>>"
_LINK = "array<struct<`@type`:string,label:string,uri:string>>"


def governance_documents(docs: DataFrame, json: str, key: str) -> dict[str, DataFrame]:
    """Tables of CIP-119 documents: one row each, their authors and their references; missing parts are null."""
    field = lambda path: F.get_json_object(json, path)
    body = [field(f"$.body.{n}").alias(n) for n in ("title", "abstract", "motivation", "rationale", "comment", "bio")]
    main = docs.select(key, field("$['@type']").alias("type"), field("$['@context']['@language']").alias("language"), *body)
    authors = docs.select(key, F.posexplode(F.from_json(field("$.authors"), _PERSON)).alias("n", "a")).select(key, "n", "a.name", F.col("a.witness.publicKey").alias("public_key"), "a.witness.signature")
    references = docs.select(key, F.posexplode(F.from_json(field("$.body.references"), _LINK)).alias("n", "r")).select(key, "n", F.col("r.@type").alias("type"), "r.label", "r.uri")
    return {"documents": main, "authors": authors, "references": references}


def pool_documents(docs: DataFrame, json: str, key: str) -> DataFrame:
    """Ticker (its first five bytes), name, description and homepage of pools."""
    ticker = F.decode(F.substring(F.encode(F.get_json_object(json, "$.ticker"), "UTF-8"), 1, 5), "UTF-8")
    return docs.select(key, ticker.alias("ticker"), *[F.get_json_object(json, f"$.{n}").alias(n) for n in ("name", "description", "homepage")])
