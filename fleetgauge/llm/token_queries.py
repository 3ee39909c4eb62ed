"""Token ids of whole texts over the test tables. SQL has no tokenizer; the tests compare with the library."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, piece_bpe, token_files
from .registry import query, table
from .storage_queries import new_folder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


@query()
def op6_token_files(spark, sf_dir):
    folder = new_folder(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), "doc_id", "text", TOKENIZER, folder, END_ID)
    rows = token_files.read(spark, folder)
    return rows.select(
        F.col("key").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def encoded(docs, keep):
    """Digests of the ids and of the text decoded from them, for rows with the columns ``keep``."""
    rows = bpe.encode(docs, "text", TOKENIZER, keep, decoded="decoded")
    return rows.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op7_bpe_automaton(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents"), ["doc_id"])


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query()
def op13_piece_rounds(spark, sf_dir):
    rows = piece_bpe.encode(table(spark, sf_dir, "documents"), "text", PIECES, ["doc_id"], decoded="decoded")
    return rows.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
