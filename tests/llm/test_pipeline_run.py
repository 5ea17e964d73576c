"""run() computes each stage once and leaves only what the last one reads."""

import os

import corpus_pipeline
from veilwork.llm import common

SF = "/root/testdata/sf0.001"


def test_each_stage_is_written_once_and_read_again(spark, monkeypatch, tmp_path):
    seen, counters = [], []

    def counted(name, stage):
        def run(session, docs, sf_dir):
            files = docs.inputFiles()
            seen.append((name, len(files) > 0 and all(("pipeline-" in f) == bool(counters) for f in files)))
            count = session.sparkContext.accumulator(0)
            counters.append(count)

            def passed(batches):
                for batch in batches:
                    count.add(batch.num_rows)
                    yield batch

            return stage(session, docs, sf_dir).mapInArrow(passed, stage(session, docs.limit(0), sf_dir).schema)

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, counted(name, stage)) for name, stage in corpus_pipeline.STAGES])
    rows = corpus_pipeline.run(spark, SF).collect()
    assert [n for n, _ in seen] == ["language_id", "line_dedup", "simhash_near_dedup", "suffix_array_dedup", "packing"] and all(ok for _, ok in seen)
    kept = [c.value for c in counters]
    assert 200 >= kept[0] == kept[1] >= kept[2] == kept[3] > 150 and kept[4] == len(rows)
    assert not common._stored


def test_only_the_last_input_stays(spark):
    folder = common.checkpoint_dir(spark).removeprefix("file:")
    before = {x for x in os.listdir(folder) if x.startswith("pipeline-")}
    corpus_pipeline.run(spark, SF)
    (new,) = {x for x in os.listdir(folder) if x.startswith("pipeline-")} - before
    assert os.listdir(f"{folder}/{new}") == ["suffix_array_dedup"]
