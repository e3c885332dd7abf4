from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from snapforge.functions import codes, crypto, dates, names, text
from snapforge.functions.json_text import with_json_columns


def column(spark, values, expression, schema="v string"):
    frame = spark.createDataFrame([(v,) for v in values], schema)
    return [row[0] for row in frame.select(expression(F.col("v"))).collect()]


def test_collection_pattern(spark):
    cases = {
        "db.core.contract.01002.4040.gz.enc": "db.core.contract",
        "core.contract.01.gz": "core.contract",
        "db.my-core.some-thing-else.1.gz": "db.my-core.some-thing",
        "db.core.contract2.1.gz": "db.core.contract",
        "dbXcore.contract.gz": "dbXcore.contract",
        "nodots": None,
        "db.core.x": "db.core",  # one letter is too short for the second part, so the match starts earlier
        "": None,
    }
    assert dict(zip(cases, column(spark, list(cases), names.collection_of))) == cases


def test_names(spark):
    given = ["db.core.contract", "core.my-coll", "db.a_b.c", "mydb.core.x", "db.db.core"]
    assert column(spark, given, names.collection_path) == ["core/contract", "core/my_coll", "a_b/c", "mycore/x", "db/core"]
    assert column(spark, given, names.folder_name) == ["core/contract", "core/my-coll", "a-b/c", "mycore/x", "db/core"]
    assert column(spark, given, names.table_name) == ["core_contract", "core_my_coll", "a_b_c", "mycore_x", "db_core"]
    special = ["db.data.businessAudit", "data.equality", "db.data.other"]
    assert column(spark, special, names.handler) == ["audit", "equality", "raw"]


def test_paths(spark):
    assert column(spark, ["a/2021-07-02/f.gz", "f"], names.base_name) == ["f.gz", "f"]
    assert column(spark, ["a/2021-07-02/f.gz", "f"], names.parent_segment) == ["2021-07-02", None]


def test_text_rules(spark):
    assert column(spark, ["a;\n ;\t\x1c;b c;   ", ";;", None], text.statements) == [["a", "b c"], [], None]
    assert column(spark, ["a\n", "a\n\n", "\n", "a"], text.drop_final_newline) == ["a", "a\n", "", "a"]
    assert column(spark, ["a\n\nb\n", "", "\n", "a"], text.lines) == [["a", "", "b"], [], [""], ["a"]]


def test_day_series(spark):
    ranges = spark.createDataFrame(
        [("2021-06-29", "2021-07-01"), ("2021-07-02", "2021-07-02"), ("2021-07-03", "2021-07-02")],
        "start_date string, end_date string",
    )
    got = [row["prefix"] for row in dates.day_prefixes(ranges, "audit/").collect()]
    assert sorted(got) == ["audit/2021-06-29/", "audit/2021-06-30/", "audit/2021-07-01/", "audit/2021-07-02/"]


def test_status_codes(spark):
    assert column(spark, ["Running", "COMPLETED", "failed", "Cancelled", "other"], codes.status_code) == [1, 2, 3, 4, None]


JSON_CASES = [
    ('{"first_name":"abcd","claimantId":"1"}', ("abcd", "1")),
    ('{"FIRST_NAME":"abcd","claimantid":"1"}', ("abcd", "1")),
    ('{"first_name":"a","First_Name":"b"}', ("b", None)),
    ('{"First_Name":"b","first_name":"a"}', ("a", None)),
    ('{"first_name":"a","first_name":"b"}', ("b", None)),
    ('{"first_name":12,"claimantId":{"a":[1,2]}}', ("12", '{"a":[1,2]}')),
    ('{"first_name":null,"claimantId":true}', (None, "true")),
    ('{"FIRST_NAME":12,"claimantId":{"a":[1,2]}}', ("12", '{"a":[1,2]}')),
    ('{"first_name":"a", "claimantId":', (None, None)),
    ("{bad", (None, None)),
    ("", (None, None)),
    ("   ", (None, None)),
    ("[1,2]", (None, None)),
    ("{}", (None, None)),
    (None, (None, None)),
]


@pytest.mark.parametrize("line,expected", JSON_CASES)
def test_json_columns(spark, line, expected):
    frame = spark.createDataFrame([(line,)], "val string")
    row = with_json_columns(frame, "val", {"first_name": "first_name", "claimantid": "claimantId"}).first()
    assert (row["first_name"], row["claimantid"]) == expected


def test_digit_first_column(spark):
    frame = spark.createDataFrame([('{"1_abroad":"x"}',)], "val string")
    assert with_json_columns(frame, "val", {"1_abroad": "1_abroad"}).first()["1_abroad"] == "x"


# NIST SP 800-38A, F.5: counter mode with 128, 192 and 256 bit keys.
CTR_COUNTER = "f0f1f2f3f4f5f6f7f8f9fafbfcfdfeff"
CTR_PLAIN = (
    "6bc1bee22e409f96e93d7e117393172aae2d8a571e03ac9c9eb76fac45af8e51"
    "30c81c46a35ce411e5fbc1191a0a52eff69f2445df4f9b17ad2b417be66c3710"
)
CTR_VECTORS = [
    (
        "2b7e151628aed2a6abf7158809cf4f3c",
        "874d6191b620e3261bef6864990db6ce9806f66b7970fdff8617187bb9fffdff"
        "5ae4df3edbd5d35e5b4f09020db03eab1e031dda2fbe03d1792170a0f3009cee",
    ),
    (
        "8e73b0f7da0e6452c810f32b809079e562f8ead2522c6b7b",
        "1abc932417521ca24f2b0459fe7e6e0b090339ec0aa6faefd5ccc2c6f4ce8e94"
        "1e36b26bd1ebc670d1bd1d665620abf74f78a7f6d29809585a97daec58c6b050",
    ),
    (
        "603deb1015ca71be2b73aef0857d77811f352c073b6108d72d9810a30914dff4",
        "601ec313775789a5b7a7f504bbf3d228f443e3ca4d62b59aca84e990cacaf5c5"
        "2b0930daa23de94ce87017ba2d84988ddfc9c58db67aada613c2dd08457941a6",
    ),
]

# EAX paper, appendix: key, nonce, message, ciphertext without its tag.
EAX_VECTORS = [
    ("91945d3f4dcbee0bf45ef52255f095a4", "becaf043b0a23d843194ba972c66debd", "f7fb", "19dd"),
    ("01f74ad64077f2e704c0f60ada3dd523", "70c3db4f0d26368400a10ed05d2bff5e", "1a47cb4933", "d851d5bae0"),
    (
        "8395fcf1e95bebd697bd010bc766aac3", "22e7add93cfc6393c57ec0b3c17d6b44",
        "ca40d7446e545ffaed3bd12a740a659ffbbb3ceab7", "cb8920f87a6c75cff39627b56e3ed197c552d295a7",
    ),
]


def transform(spark, data, key, iv, cipher):
    frame = spark.createDataFrame(
        [(bytearray.fromhex(data), bytearray.fromhex(key), bytearray.fromhex(iv))], "d binary, k binary, i binary"
    )
    started = crypto.with_start(frame, cipher, "i", "k")
    return started.select(F.hex(crypto.ctr_transform(F.col("d"), F.col("k"), F.col("start")))).first()[0].lower()


@pytest.mark.parametrize("key,sealed", CTR_VECTORS)
def test_ctr_vectors(spark, key, sealed):
    assert transform(spark, CTR_PLAIN, key, CTR_COUNTER, "ctr") == sealed
    assert transform(spark, sealed, key, CTR_COUNTER, "ctr") == CTR_PLAIN


@pytest.mark.parametrize("key,nonce,plain,sealed", EAX_VECTORS)
def test_eax_vectors(spark, key, nonce, plain, sealed):
    assert transform(spark, sealed, key, nonce, "eax") == plain


# RFC 4493 gives CMAC values of messages of 0, 16, 40 and 64 bytes. The EAX start is the CMAC of a zero block and the
# nonce, so a reference CMAC built on one-block encryption covers every other nonce length.
def cmac(encrypt, message: bytes) -> bytes:
    def double(block: bytes) -> bytes:
        number = int.from_bytes(block, "big") << 1
        if number >> 128:
            number = (number ^ 0x87) & ((1 << 128) - 1)
        return number.to_bytes(16, "big")

    def xor(a: bytes, b: bytes) -> bytes:
        return bytes(x ^ y for x, y in zip(a, b))

    subkey = double(encrypt(bytes(16)))
    blocks = [message[i:i + 16] for i in range(0, len(message), 16)] or [b""]
    last = blocks.pop()
    if len(last) < 16:
        last, subkey = (last + b"\x80").ljust(16, b"\0"), double(subkey)
    state = bytes(16)
    for block in blocks:
        state = encrypt(xor(state, block))
    return encrypt(xor(xor(state, last), subkey))


@pytest.mark.parametrize("size", [1, 15, 16, 17, 33, 48, 50, 64, 65, 1000])
def test_eax_nonce_lengths(spark, size):
    key, nonce = bytes(range(16)), bytes((7 * i + 200) % 256 for i in range(size))

    def encrypt(block: bytes) -> bytes:
        frame = spark.range(1).select(crypto.encrypt_block(F.lit(block), F.lit(key)))
        return bytes(frame.first()[0])

    frame = spark.createDataFrame([(bytearray(nonce), bytearray(key))], "n binary, k binary")
    assert bytes(crypto.with_start(frame, "eax", "n", "k").first()["start"]) == cmac(encrypt, bytes(16) + nonce)


def test_cmac_reference(spark):
    """RFC 4493, example 3 and 4."""
    key = bytes.fromhex("2b7e151628aed2a6abf7158809cf4f3c")

    def encrypt(block: bytes) -> bytes:
        return bytes(spark.range(1).select(crypto.encrypt_block(F.lit(block), F.lit(key))).first()[0])

    message = bytes.fromhex(CTR_PLAIN)
    assert cmac(encrypt, message[:40]).hex() == "dfa66747de9ae63030ca32611497c827"
    assert cmac(encrypt, message).hex() == "51f0bebf7e3b9d92fc49741779363cfe"


def test_counter_carries(spark):
    """The counter runs over the end of both halves."""
    frame = spark.createDataFrame([(bytearray(48), bytearray(b"\xff" * 15 + b"\xfe"))], "d binary, s binary")
    got = frame.select(F.hex(crypto.counter_blocks(F.col("d"), F.col("s"), F.lit(0).cast("long")))).first()[0]
    assert got.lower() == "f" * 31 + "e" + "f" * 32 + "0" * 32
    skipped = spark.createDataFrame([(bytearray(1), bytearray(b"\0" * 8 + b"\xff" * 8))], "d binary, s binary")
    got = skipped.select(F.hex(crypto.counter_blocks(F.col("d"), F.col("s"), F.lit(1).cast("long")))).first()[0]
    assert got == "0" * 15 + "1" + "0" * 16


def test_short_iv_is_a_number(spark):
    frame = spark.createDataFrame([(bytearray(b"\x01\x02"),)], "v binary")
    assert bytes(frame.select(crypto.ctr_start(F.col("v"))).first()[0]) == bytes(14) + b"\x01\x02"
    assert column(spark, [bytearray(b""), bytearray(17)], crypto.ctr_start, "v binary") == [None, None]
