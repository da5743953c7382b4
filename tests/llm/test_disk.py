"""What the operators have on disk at a time: shuffle files and what lies in the shared folder."""

import os
import random
import threading
import time

import numpy as np

from granary.llm.near_duplicates import NearDuplicates
from granary.llm.neighbours import Neighbours
from granary.llm.split_overlaps import NearOverlaps, SplitOverlaps, parities
from granary.runtime import shared_folder


def peak(spark, run):
    """The most bytes that lie on disk while run() goes on, besides those from before."""
    at = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    at.append(shared_folder(spark).removeprefix("file:"))

    def used():
        total = 0
        for d in at:
            for folder, _, files in os.walk(d):
                for f in files:
                    try:
                        total += os.path.getsize(os.path.join(folder, f))
                    except OSError:
                        pass  # removed meanwhile
        return total

    def watch():
        while not over.is_set():
            seen.append(used())
            time.sleep(0.02)

    spark.sparkContext._jvm.System.gc()
    time.sleep(1)
    before, seen, over = used(), [], threading.Event()
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        run()
    finally:
        over.set()
        watcher.join()
    return max(seen) - before


def test_near_duplicates_store_a_part_of_their_keys_at_a_time(spark):
    rng = random.Random(4)
    rows = [(f"d{i}", [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=40))], 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id string, doc_text array<string>, loaded_at int")
    how = NearDuplicates(n=3, threshold=0.6, round_rows=1)
    rows_a_key = 8 + 8  # and 160 keys a text
    assert peak(spark, lambda: how.pairs(df).collect()) < 0.6 * 160 * 2000 * rows_a_key


def test_near_overlaps_store_a_part_of_their_hashes_at_a_time(spark):
    rng = random.Random(5)
    rows = [(f"q{i}", "".join(rng.choices("abcdefgh ", k=30)), rng.choice(["train", "dev"]), "s", 1) for i in range(8000)]
    df = spark.createDataFrame(rows, "query_id string, query_text string, split string, source string, loaded_at int")
    rows_a_hash = 8 + 8  # and 45 hashes a text
    assert peak(spark, lambda: SplitOverlaps(NearOverlaps(round_rows=1)).pairs(df).collect()) < 45 * 8000 * rows_a_hash


def test_parities_differ_at_most_as_often_as_the_sets():
    rng = np.random.default_rng(6)
    sets = [set(rng.integers(0, 400, n).tolist()) for n in (1, 5, 40, 40, 120, 300)]
    values = np.array([x for s in sets for x in sorted(s)], dtype=np.uint64)
    words = parities(values, np.cumsum([0, *map(len, sets)])[:-1])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            apart = sum((int(w[i] ^ w[j]) & (2**64 - 1)).bit_count() for w in words)
            assert apart <= len(a ^ b) and (apart - len(a ^ b)) % 2 == 0


def test_a_vector_is_not_stored_once_for_each_leaf_it_visits(spark):
    rng = np.random.default_rng(7)
    rows = [(f"v{i}", v) for i, v in enumerate(rng.normal(size=(3000, 64)).astype(np.float32).tolist())]
    df = spark.createDataFrame(rows, "id string, v array<float>")
    how = Neighbours(dim=64, recall=1.0, leaf_rows=100, round_rows=1)  # visits nearly all of some 30 leaves
    assert peak(spark, lambda: how.search(df, "id", "v").collect()) < 12 * 3000 * 64 * 4
