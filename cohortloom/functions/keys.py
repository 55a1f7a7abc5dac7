"""Surrogate ids and pseudonyms as plain column expressions."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_SPACE = 10**9


def surrogate_id(source_id: Column, source_type: str, modulus: int = ID_SPACE) -> Column:
    """Version-5 UUID of ``source_id`` in the namespace of ``source_type``, modulo ``modulus``.

    The 128 bits are read as two longs and handled as four 32-bit words, so that everything is
    long arithmetic.
    The default id space holds 10^9 values; a larger modulus (up to 10^18) keeps ids of very
    large tables from colliding.
    """
    if not 0 < modulus <= 10**18:
        raise ValueError("modulus must be in 1 .. 10^18")
    namespace = uuid.uuid5(uuid.NAMESPACE_DNS, source_type).bytes
    digest = F.sha1(F.concat(F.lit(namespace), F.encode(source_id.cast("string"), "UTF-8")))

    def half(k: int) -> Column:
        # a negative base makes a signed number, so all 64 bits fit a long
        return F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("long")

    high, low = half(0), half(1)
    # version nibble 5 and the variant bits, as the UUID standard sets them
    words = [
        F.shiftrightunsigned(high, 32),
        high.bitwiseAND(F.lit(0xFFFF0FFF)).bitwiseOR(F.lit(0x5000)),
        F.shiftrightunsigned(low, 32).bitwiseAND(F.lit(0x3FFFFFFF)).bitwiseOR(F.lit(0x80000000)),
        low.bitwiseAND(F.lit(0xFFFFFFFF)),
    ]
    weights = [2 ** (96 - 32 * k) % modulus for k in range(4)]
    if modulus <= 2**30:
        parts = [(w % modulus) * F.lit(x).cast("long") for w, x in zip(words, weights)]
        return (parts[0] + parts[1] + parts[2] + parts[3]) % modulus
    wide = "decimal(18,0)"
    parts = [
        (w.cast(wide) * F.lit(str(x)).cast(wide)) % F.lit(str(modulus)).cast("decimal(19,0)")
        for w, x in zip(words, weights)
    ]
    total = sum((p.cast("decimal(20,0)") for p in parts[1:]), parts[0].cast("decimal(20,0)"))
    return (total % F.lit(str(modulus)).cast("decimal(19,0)")).cast("long")


def id_collisions(df: DataFrame, id_column: str, source_column: str) -> DataFrame:
    """Ids that stand for more than one source value, with the number of values."""
    pairs = df.select(id_column, source_column).distinct()
    return pairs.groupBy(id_column).agg(F.count("*").alias("sources")).filter("sources > 1")


def cipher_key(secret: str) -> bytes:
    return hashlib.sha256(secret.encode()).digest()[:16]


def pseudonym(c: Column, secret: str) -> Column:
    """Deterministic cipher text of a key: AES-128 ECB over the blank-padded key, base64.

    Equal keys give equal pseudonyms on purpose, they are join keys. Spark always appends a
    padding block, which is cut off again because the text is already whole blocks.
    """
    text = F.replace(c, F.lit("-"), F.lit(""))
    width = F.greatest(F.lit(16), (F.ceil(F.octet_length(text) / 16) * 16).cast("int"))
    padded = F.concat(text, F.repeat(F.lit(" "), width - F.octet_length(text)))
    cipher = F.aes_encrypt(padded, F.lit(cipher_key(secret)), F.lit("ECB"), F.lit("PKCS"))
    blocks = F.substring(cipher, F.lit(1), width)
    return F.translate(F.base64(blocks), "+/\r\n", "-_")


def reveal(c: Column, secret: str) -> Column:
    """The key a pseudonym stands for, null for a text that is no pseudonym.

    What another secret made gives null or a text that no key has.
    """
    key = F.lit(cipher_key(secret))
    padding = F.aes_encrypt(F.lit(b""), key, F.lit("ECB"), F.lit("PKCS"))
    cipher = F.try_to_binary(F.translate(c, "-_", "+/"), F.lit("base64"))
    size = F.octet_length(cipher)
    blocks = F.when((size > 0) & (size % 16 == 0), F.concat(cipher, padding))
    plain = F.try_aes_decrypt(blocks, key, F.lit("ECB"), F.lit("PKCS"))
    # one mention only: each would decipher again
    return F.trim(F.try_validate_utf8(plain.cast("string")))


def joined_key(*columns: Column) -> Column:
    """Composite text key, parts joined with '_'."""
    return F.concat_ws("_", *[c.cast("string") for c in columns])
