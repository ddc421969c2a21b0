"""op2: byte-level BPE through a sentencepiece model serialised from the vocabulary.

The rank file (token bytes, rank) becomes a sentencepiece BPE ``ModelProto``: every
byte maps to one printable character, a token is the string of its bytes' characters,
its score is the negative rank (sentencepiece merges the best score first, leftmost
among equals: the lowest rank first), and the normaliser is the identity. Text is cut
into pre-tokens by the pattern; each pre-token's bytes are encoded by the model on
their own. Decoding is the inverse mapping from ids to bytes.

A worker keeps pre-token -> ids in a dictionary that is emptied when it reaches
``CACHE_ENTRIES`` (this only bounds memory; results do not depend on it). The model,
about one megabyte whatever the data, goes to the workers with the function.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tabsmith.llm.common import lean, table

CACHE_ENTRIES = 400_000
BATCH_ROWS = 1_000  # of the output
# white space of the Unicode property (also what \s means to the rank files' own library);
# the regex module's \s would add the four separators 0x1C to 0x1F
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_characters() -> list[str]:
    """One printable character per byte: itself where printable, else 256 and up."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes | int) -> bytes:
    """A protocol buffer field: varint for an int, length-delimited for bytes."""
    if isinstance(payload, int):
        return _varint(number << 3) + _varint(payload)
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def serialise_model(ranks: dict[bytes, int]) -> tuple[bytes, list[int]]:
    """The sentencepiece model file's bytes, and the rank of every piece id.

    Piece 0 is the unknown piece the format requires; pieces follow in rank order.
    """
    chars = byte_characters()
    proto = bytearray()

    def piece(text: str, score: float, kind: int) -> None:
        body = _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _field(3, kind)
        proto.extend(_field(1, body))

    piece("<unk>", 0.0, 2)
    rank_of_piece = [-1]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece("".join(chars[b] for b in token), -float(rank), 1)
        rank_of_piece.append(rank)
    # trainer: model_type BPE, vocabulary size, no beginning / end / padding pieces
    minus_one = (1 << 64) - 1
    trainer = b"".join([_field(3, 2), _field(4, len(rank_of_piece)), _field(40, 0), _field(41, minus_one),
                        _field(42, minus_one), _field(43, minus_one)])
    # normaliser: identity, no dummy prefix, white space neither removed nor escaped
    normaliser = b"".join([_field(1, b"identity"), _field(3, 0), _field(4, 0), _field(5, 0)])
    proto.extend(_field(2, trainer) + _field(3, normaliser))
    return bytes(proto), rank_of_piece


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, model: bytes, rank_of_piece: list[int]):
        import sentencepiece

        self._spm = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._find = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]")
                                   .replace(r"\s", f"[{WHITE}]")).findall
        self._rank_of_piece = np.array(rank_of_piece, np.int64)
        self._chars = byte_characters()
        self._whole = {t.decode(): r for t, r in ranks.items() if _is_text(t)}
        self._token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._token[rank] = token
        self._known = _Known(self)

    def _encode_piece(self, pre_token: str) -> bytes:
        """Little-endian ids of one pre-token; a pre-token that is a token is one id."""
        rank = self._whole.get(pre_token)
        if rank is not None:
            return struct.pack("<I", rank)
        mapped = "".join([self._chars[b] for b in pre_token.encode()])
        return self._rank_of_piece[self._spm.encode(mapped)].astype("<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._known.__getitem__, self._find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Known(dict):
    def __init__(self, codec: Codec):
        super().__init__()
        self._codec = weakref.proxy(codec)  # no cycle: the cache goes with the task, not at some later collection

    def __missing__(self, pre_token: str) -> bytes:
        ids = self._codec._encode_piece(pre_token)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        if len(pre_token) <= 64:
            self[pre_token] = ids
        return ids


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 and n_bytes (of the decoded
    text); with ``with_ids`` also ids (array<int>). A null text counts as empty: no
    tokens and the digests of no bytes. Rows are encoded one by one, so repeats, null
    ids and an empty table need no special case. ``vocabulary`` is read on the driver.
    """
    ranks = read_ranks(vocabulary)
    model, rank_of_piece = serialise_model(ranks)
    id_type = dict(docs.dtypes)["doc_id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks, pattern, model, rank_of_piece)
        for batch in (whole.slice(k, BATCH_ROWS) for whole in batches for k in range(0, whole.num_rows, BATCH_ROWS)):
            n_tokens, id_digest, text_digest, n_bytes, ids_out = [], [], [], [], []
            for value in batch.column("text"):
                ids = codec.encode(value.as_py() or "")
                text = codec.decode(ids)
                n_tokens.append(len(ids) // 4)
                id_digest.append(hashlib.sha256(ids).hexdigest())
                text_digest.append(hashlib.sha256(text).hexdigest())
                n_bytes.append(len(text))
                if with_ids:
                    ids_out.append(np.frombuffer(ids, "<i4"))
            arrays = [batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(id_digest, pa.string()),
                      pa.array(text_digest, pa.string()), pa.array(n_bytes, pa.int64())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
    return docs.select("doc_id", "text").mapInArrow(lean(encode), schema + (", ids array<int>" if with_ids else ""))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)
