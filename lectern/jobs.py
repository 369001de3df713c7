"""Jobs for ``spark-submit``: ``python -m lectern.jobs <job> --name value``. Each reads tables, runs one flow and writes its result.

  ingest  --files DIR --agent ID --key KEY --store DIR --manifests DIR   new and changed files to stored records
  chunks  --artifacts TABLE --store DIR                                   stored records to stored chunks
  index   --artifacts TABLE --store DIR --dimensions N                    stored records to a vector index, offline provider
  report  --inventory TABLE --results TABLE --store DIR                   a corpus run as a report by type of file
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lectern.operators import chunking, pipeline, vectors
from lectern.sources import office

MANIFEST = "document_id string, source_version string, source_hash string, processing_key string, artifact_status string, created_at timestamp"


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    held = pipeline.read_or_none(spark, args.manifests, MANIFEST)
    files = office.read_files(spark, args.files).select("path", "content")
    made = pipeline.ingest_and_persist(files, spark.createDataFrame([], MANIFEST) if held is None else held, args.agent, args.key, args.store)
    made.write.mode("append").parquet(args.manifests)


def chunks(spark: SparkSession, args: argparse.Namespace) -> None:
    policy = chunking.Policy()
    pipeline.persist_chunks(chunking.chunk_artifacts(spark.read.parquet(args.artifacts), policy), policy, args.store)


def index(spark: SparkSession, args: argparse.Namespace) -> None:
    made = pipeline.index(spark.read.parquet(args.artifacts), vectors.hashed_provider(args.dimensions), f"hashed-{args.dimensions}", args.dimensions)
    made.write.mode("errorifexists").partitionBy("collection").parquet(args.store)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    pipeline.save_report(pipeline.corpus_report(spark.read.parquet(args.inventory), spark.read.parquet(args.results)), args.store)


JOBS = {"ingest": (ingest, ("files", "agent", "key", "store", "manifests")), "chunks": (chunks, ("artifacts", "store")), "index": (index, ("artifacts", "store", "dimensions")), "report": (report, ("inventory", "results", "store"))}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lectern.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (_, wanted) in JOBS.items():
        job = jobs.add_parser(name)
        for option in wanted:
            job.add_argument(f"--{option}", required=True, type=int if option == "dimensions" else str)
    args = parser.parse_args(argv)
    JOBS[args.job][0](spark or SparkSession.builder.appName(f"lectern-{args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
