"""Near duplicates among texts by SimHash, made whole: every pair alike in its word shingles ends in one group.

The spanning forests of fingerprints within the radius, confirmed on the sets of shingles, join most of a group. They follow bits,
not likeness, so what they leave apart meets by the keys of MinHash signatures (``minhash.open_links``). One pass
over the texts makes hash, fingerprint and signature; only texts that meet another one are read again, once, for their sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm import minhash
from trackflow.llm.graph import components
from trackflow.llm.simhash import fingerprint, near_links, shingle_hashes
from trackflow.llm.work import map_rows, staged

#: What stands for the shingles of a text without words: all such texts are alike.
NOTHING = np.zeros(1, dtype=np.uint64)


def near_groups(docs: DataFrame, shingle_words: int = 5, radius: int = 12, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``component`` and ``kept`` of texts whose word shingles are alike by Jaccard in ``similarity`` or more.

    ``kept`` is true for the rows whose id is the smallest of their component; of different texts under that id, for the one
    of the smallest hash. Equal texts are one node, so copies do not meet; ``text_hash`` is the SHA-256 of the text. Null texts are
    empty and, like all texts without words, alike. Rows with a null id are left out. Sets are compared as 32-bit hashes; of pairs
    alike in exactly 0.8, keys miss one in about 300,000 that the fingerprints miss as well.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def marks(ids: list, texts: list) -> list:
        hashes, fps, sizes, sigs = [], [], [], []
        for t in texts:
            h = shingle_hashes(t, shingle_words)
            own = np.unique(h) if len(h) else NOTHING
            fp = fingerprint(h)
            hashes.append(hashlib.sha256((t or "").encode()).digest())
            fps.append(fp - (1 << 64) if fp >> 63 else fp)
            sizes.append(len(own))
            sigs.append(minhash.signature(own))
        return [ids, hashes, fps, sizes, sigs]

    source = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = staged(map_rows(source, marks, f"doc_id {id_type}, hash binary, fp long, n long, sig binary"), "fingerprints")
    nodes = marked.groupBy("hash").agg(F.min("doc_id").alias("first"), F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("sig").alias("sig"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    close = near_links(nodes.select(F.col("node").alias("id"), "fp", F.col("n").alias("size")), radius, ratio=similarity)
    close = staged(close.select("a", "b"), "links")
    shared = staged(minhash.shared_keys(nodes).select("key", "node"), "shared")

    def cut(hashes: list, texts: list, *rest: list) -> list:
        right = [k for k, (t, h) in enumerate(zip(texts, hashes, strict=True)) if hashlib.sha256((t or "").encode()).digest() == h]  # an id may have other texts
        sets = []
        for k in right:
            h = shingle_hashes(texts[k], shingle_words)
            sets.append(minhash.elements(np.unique(h) if len(h) else NOTHING))
        return [sets, *([column[k] for k in right] for column in rest)]

    met = close.select(F.explode(F.array("a", "b")).alias("node")).unionByName(shared.select("node")).distinct()
    needed = met.join(nodes.select("node", "hash", "n", "sig", F.col("first").alias("doc_id")), "node")
    found = source.join(needed, "doc_id").select("hash", "text", "node", "n", "sig")
    sets = staged(map_rows(found, cut, "elements binary, node long, n long, sig binary").dropDuplicates(["node"]), "sets")

    linked = staged(minhash.confirmed(minhash.from_centres(close, sets), similarity), "confirmed")
    rest = staged(minhash.open_links(shared, components(linked), sets, similarity), "rest")
    found = components(linked.unionByName(rest)).withColumnRenamed("id", "node")
    rooted = staged(nodes.join(found, "node", "left").select("hash", "first", F.coalesce("component", "node").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min(F.struct("first", "hash")).alias("least"))
    owned = staged(rooted.join(least, "root").select("hash", F.col("least.first").alias("component"), (F.col("hash") == F.col("least.hash")).alias("own")), "owned")
    of_text = marked.select("doc_id", "hash").join(owned, "hash")
    return of_text.select("doc_id", F.lower(F.hex("hash")).alias("text_hash"), "component", (F.col("own") & (F.col("doc_id") == F.col("component"))).alias("kept"))
