"""One curation run over landed files, as cron-started batch jobs.

    python examples/batch_run.py prepare FEED_DIR PAGES_PATH OUT_DIR BATCH
    python examples/batch_run.py check   RESPONSES OUT_DIR BATCH
    python examples/batch_run.py deliver CHECKED REWRITES OUT_DIR BATCH
    python examples/batch_run.py confirm CHECKED REWRITES ANSWERS OUT_DIR BATCH

FEED_DIR holds landed feed files, PAGES_PATH a table of (url, html); RESPONSES,
CHECKED and REWRITES are tables of (article_id, response) written by the model's
three steps, ANSWERS one of (article_id, answer) from the publishing service.
``prepare`` writes the prompts, ``check`` those of the fact check, ``deliver`` the
prompts of posts to rewrite and the outbox, ``confirm`` drafts, outcomes, the run
row and the ledger.  OUT_DIR is a folder that driver and executors share.
"""

from __future__ import annotations

import os
import sys
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from gleaner.plans import jobs  # noqa: E402
from gleaner.session import SESSION_CONF  # noqa: E402
from gleaner.sources.feed import read_feed  # noqa: E402
from gleaner.sources.tables import read_ledger, read_pages  # noqa: E402


def main(step: str, *args: str) -> None:
    *tables, out_dir, batch = args
    b = SparkSession.builder.appName("gleaner-run").config("spark.checkpoint.dir", f"{out_dir}/work")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    batch_id = int(batch)
    if step == "prepare":
        prep = jobs.prepare(read_feed(spark, tables[0]), read_pages(spark, tables[1]), read_ledger(spark, f"{out_dir}/ledger"))
        jobs.save_prepared(prep, out_dir, batch_id)
        return
    prep = jobs.load_prepared(spark, out_dir, batch_id)
    responses = spark.read.parquet(tables[0])
    if step == "check":
        jobs.fact_check_table(prep, responses).write.mode("overwrite").parquet(f"{out_dir}/fact_check/batch_id={batch_id}")
        return
    rewrites = None if tables[1] == "-" else spark.read.parquet(tables[1])  # "-": none have landed
    sent = jobs.deliver(prep, responses, rewrites=rewrites)
    if step == "deliver":
        jobs.promo_rewrite_table(prep, responses).write.mode("overwrite").parquet(f"{out_dir}/rewrite/batch_id={batch_id}")
        sent.outbox.write.mode("overwrite").parquet(f"{out_dir}/outbox/batch_id={batch_id}")
        return
    run_id = jobs.run_id(out_dir, batch_id, datetime.now(timezone.utc))
    jobs.write_outputs(jobs.confirm(prep, sent, spark.read.parquet(tables[2]), run_id), out_dir, batch_id)


if __name__ == "__main__":
    main(*sys.argv[1:])
