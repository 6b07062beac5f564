from pyspark.sql import types as T

from streamfold.functions.schema import (Field, declared_fields, fields_from_handles, primary_key,
                                         to_struct)


def test_handles_types_and_fallback():
    f = fields_from_handles([["a", "string"], ["b", "DOUBLE"], ["c", "decimal"], ["bad"], ("d", "BIGINT")])
    assert [(x.name, x.type) for x in f] == [("a", "STRING"), ("b", "DOUBLE"), ("c", "STRING"), ("d", "BIGINT")]


def test_precedence_and_default(spark):
    assert [x.name for x in declared_fields(None, None)] == ["id", "payload"]
    assert [x.name for x in declared_fields([["x", "INT"]], None)] == ["x"]
    f = declared_fields([["x", "INT"]], "symbol STRING, price DOUBLE, n BIGINT, ok BOOLEAN")
    assert [(x.name, x.type) for x in f] == [("symbol", "STRING"), ("price", "DOUBLE"), ("n", "BIGINT"),
                                             ("ok", "BOOLEAN")]


def test_struct_types():
    st = to_struct([Field("a", "FLOAT"), Field("b", "INT"), Field("c", "BYTES")])
    assert [type(f.dataType) for f in st.fields] == [T.FloatType, T.IntegerType, T.BinaryType]


def test_primary_key_rules():
    fields = [Field("a"), Field("b")]
    assert primary_key(None, fields) == ["a"]
    assert primary_key([], fields) == ["a"]
    assert primary_key("b", fields) == ["b"]
    assert primary_key(["a", "b"], fields) == ["a", "b"]
    assert primary_key(None, []) == ["id"]
