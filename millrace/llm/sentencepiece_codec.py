"""SentencePiece encoding and decoding of whole documents, by the prefix table of `piece_bpe`."""
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.piece_bpe import piece_bpe
from millrace.llm.tables import slices


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and ids (array of int) of every row, without begin or end ids.

    Null and empty texts have no ids. Very long texts are encoded as a whole, one at a time. There are no ties: a text has
    one encoding, and repeated rows give repeated results. An empty table gives an empty result. Columns of docs other than
    doc_id and text, whatever their names, are not looked at.
    """

    def run(batches):
        bpe = piece_bpe(model_path)
        for batch in slices(batches):
            ids = pa.array([bpe.encode(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids.

    Null and empty ids give an empty text; of ids of any number the text is made as a whole. Repeated rows give repeated
    results, an empty table an empty one. Columns other than doc_id and ids, whatever their names, are not looked at.
    """

    def run(batches):
        bpe = piece_bpe(model_path)
        for batch in slices(batches):
            texts = pa.array([bpe.decode(ids or ()) for ids in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, in one pass that ships no ids.

    Each text is encoded and its ids decoded again; the digests are those of the decimal ids joined by commas and of
    the decoded UTF-8. What is the same for a chunk wherever it stands is kept by chunk, ids and decoded text alike.
    Null texts are as empty ones. Very long texts are read as a whole, one at a time. There are no ties: a text has one
    encoding, and repeated rows give repeated results. An empty table gives an empty result. Columns of docs other than
    doc_id and text, whatever their names, are not looked at.
    """

    def run(batches):
        bpe = piece_bpe(model_path)
        kept = bpe.rendered

        def render(ids):  # a chunk's decoded text keeps its space: decode() drops that of the first chunk only
            return len(ids), ",".join(map(str, ids)), " " + bpe.decode(ids)

        for batch in slices(batches):
            n, spelt, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                if text and bpe.single_spaced(text):
                    parts = bpe.chunks(text, render, kept)
                    n.append(sum([p[0] for p in parts]))
                    ids, back = ",".join([p[1] for p in parts]), "".join([p[2] for p in parts])[1:]
                else:
                    own = bpe.encode(text)
                    n.append(len(own))
                    ids, back = ",".join(map(str, own)), bpe.decode(own)
                spelt.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(spelt, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
