"""``python -m weirflow.jobs CONFIG CHECKPOINT [STAGED_FOLDER]``: runs a pipeline from a YAML file.

Reflow requests are read from their topics and the documents they ask for staged from the configured store, in
CHECKPOINT-staged unless a folder is given. Without a store someone else writes the folder. Malformed messages go to
kafka.dead-letter-topic, or to the folder CHECKPOINT-dead-letters.
"""

from __future__ import annotations

import sys

from . import sinks
from .config import load
from .plans import pipeline
from .session import builder


def main(args: list[str]) -> None:
    cfg = load(args[0]).validate()
    spark = builder().getOrCreate()
    staged, stage = args[2] if len(args) > 2 else None, None
    if cfg.reflow_names() and cfg.elasticsearch.hosts:
        staged = staged or f"{args[1].rstrip('/')}-staged"
        stage = pipeline.stage_requests(spark, cfg, pipeline.remote_store(spark, cfg), staged, f"{args[1].rstrip('/')}-requests")
    elif cfg.reflow_names() and staged is None:
        raise ValueError("reflow needs elasticsearch.hosts, or STAGED_FOLDER with documents that are staged already")
    values = pipeline.stream_documents(spark, cfg, staged_folder=staged)
    query = sinks.write(values, args[1], cfg.kafka.bootstrap_servers, cfg.kafka.output_topic)
    dead = None
    if cfg.malformed == "dead_letter" and (cfg.mode == "REALTIME" or cfg.reflow_names()):
        base, topic = args[1].rstrip("/"), cfg.kafka.dead_letter_topic
        dead = sinks.write(pipeline.dead_letters(spark, cfg, staged_folder=staged), f"{base}-dead", cfg.kafka.bootstrap_servers, topic, None if topic else f"{base}-dead-letters")
    if cfg.mode == "OFFLINE":
        if stage:
            stage.processAllAvailable()
            stage.stop()
        sinks.drain(query, cfg.joiner.timeout_ms / 1000 + 30)
        if dead:
            dead.processAllAvailable()
            dead.stop()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
