from hashlib import sha256

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from support import rows
from tierflow.functions import protect

KEY = b"0123456789abcdef0123456789abcdef"


def one(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "c string")


def test_token_and_null(spark):
    df = protect.hash_column(one(spark, "a", None), "c", "x")
    assert rows(df, "c_token") == sorted(
        [(sha256(b"ax").hexdigest(),), (sha256(b"x").hexdigest(),)], key=repr
    )


def test_mapping_is_unique(spark):
    mapping = protect.create_token_mapping(one(spark, "a", "a", "b"), "c")
    assert mapping.count() == 2 and mapping.columns == ["c", "c_token"]


def test_masks(spark):
    assert rows(protect.mask_email(one(spark, "user@example.com"), "c")) == [("u***@e***.com",)]
    assert rows(protect.mask_phone(one(spark, "555-123-4567"), "c")) == [("XXX-XXX-4567",)]
    for text, hidden in {
        "write a@b.com or c@d.org": "write a***@b***.com or c***@d***.org",
        "a@b.com,c@d.org": "a***@b***.com,c***@d***.org",
        "a@b@c.de": "a***@b***@c.de",
        "see (é.x@büro.de)!": "see (é***@b***.de)!",
        "o'neil/x=1@host": "o***@h***",
        "mail: x@[10.0.0.1].": "mail: x***@[1***.0.0.1].",
        "x @ y.com": "x @ y.com",
    }.items():
        assert rows(protect.mask_email(one(spark, text), "c")) == [(hidden,)]
    untouched = one(spark, "no mail here", None)
    assert rows(protect.mask_email(untouched, "c")) == rows(untouched)
    many = protect.mask_phone(one(spark, "call 555-123-4567 or 555-999-0000"), "c")
    assert rows(many) == [("call XXX-XXX-4567 or XXX-XXX-0000",)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.characters(codec="utf-8"))), min_size=1))
def test_encryption_is_undone(spark, values):
    df = one(spark, *values)
    assert rows(protect.decrypt_column(protect.encrypt_column(df, "c", KEY), "c", KEY)) == rows(df)


def test_encryption_hides_and_checks_keys(spark):
    cipher = protect.encrypt_column(one(spark, "secret", "secret"), "c", KEY)
    values = [r[0] for r in rows(cipher)]
    assert "secret" not in values and values[0] != values[1]
    with pytest.raises(ValueError, match="32 bytes"):
        protect.encrypt_column(cipher, "c", b"short")
    with pytest.raises(ValueError, match="algorithm"):
        protect.encrypt_column(cipher, "c", KEY, "DES")
    assert rows(protect.encrypt_column(one(spark, None), "c", KEY)) == [(None,)]


def test_policy(spark):
    df = spark.createDataFrame([("u@e.com", "n", "p")], "mail string, name string, plain string")
    result = protect.protect_columns(
        df,
        {
            "mail": {"action": "mask_email"},
            "name": {"action": "hash", "salt": "s", "drop": True},
            "gone": {"action": "hash"},
        },
    )
    assert rows(result) == [("u***@e***.com", "p", sha256(b"ns").hexdigest())]
    with pytest.raises(ValueError, match="unknown protection"):
        protect.protect_columns(df, {"mail": {"action": "shred"}})
