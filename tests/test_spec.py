import json

import pytest

from tableflow.spec import NO_INDEX, PipelineSpec, SourceSpec, TargetSpec, lookup

SOURCE = {"id": "a", "source": "hdfs"}


def spec(**body):
    return PipelineSpec.from_dict({"source": {"mapping": [SOURCE]} | body})


def test_missing_fields_have_defaults():
    source = SourceSpec.from_dict(SOURCE)
    assert source.index == NO_INDEX
    assert (source.location, source.format, source.join, source.where) == ("", "", "", "")
    assert (source.column_family, source.transform) == ("", "")
    assert source.columns is None and source.custom == {}


@pytest.mark.parametrize(
    "value, index",
    [(3, 3), ("3", 3), ("+3", 3), ("-3", -3), ("x", NO_INDEX), ("2.0", NO_INDEX), (None, NO_INDEX)]
    + [(True, NO_INDEX), ("", NO_INDEX), (2**31, NO_INDEX), (" 3", NO_INDEX), ("1_0", NO_INDEX)],
)
def test_index_is_an_integer_or_the_default(value, index):
    assert SourceSpec.from_dict(SOURCE | {"index": value}).index == index


def test_text_fields_take_any_value():
    source = SourceSpec.from_dict(SOURCE | {"where": True, "location": 7})
    assert (source.where, source.location) == ("True", "7")


def test_column_family_is_one_key_or_nested():
    assert SourceSpec.from_dict(SOURCE | {"column.family": "raw"}).column_family == "raw"
    assert SourceSpec.from_dict(SOURCE | {"column": {"family": "raw"}}).column_family == "raw"


def test_custom_is_an_object_or_its_json():
    assert SourceSpec.from_dict(SOURCE | {"custom": '{"a": "b"}'}).custom == {"a": "b"}
    assert SourceSpec.from_dict(SOURCE | {"custom": {"a": "b"}}).custom == {"a": "b"}
    for wrong in ("{", "[1]", 3):
        with pytest.raises(ValueError, match="custom of source 'a'"):
            SourceSpec.from_dict(SOURCE | {"custom": wrong})


def test_columns_must_be_names():
    for wrong in ([], "a"):
        with pytest.raises(ValueError, match="columns of source 'a'"):
            SourceSpec.from_dict(SOURCE | {"columns": wrong})


def test_a_source_needs_an_id():
    with pytest.raises(ValueError, match="without an id"):
        SourceSpec.from_dict({"source": "hdfs", "id": " "})


def test_filter_and_derived_columns_are_optional():
    assert spec().where == "" and spec().add_columns == [] and spec().target is None
    given = spec(**{"where.clause": "x > 1", "add.columns": [["n", "1"]]})
    assert given.where == "x > 1" and given.add_columns == [("n", "1")]
    nested = spec(where={"clause": "x > 1"}, add={"columns": [["n", "1"]]})
    assert nested == given


@pytest.mark.parametrize("entry", [["n"], ["n", "1", "2"], "n", []])
def test_derived_columns_of_the_wrong_size_are_refused(entry):
    with pytest.raises(ValueError, match="add.columns"):
        spec(**{"add.columns": [entry]})


@pytest.mark.parametrize("mapping", [None, [], "a"])
def test_sources_are_required(mapping):
    with pytest.raises(ValueError, match="source.mapping"):
        PipelineSpec.from_dict({"source": {"mapping": mapping}})


def test_settings_become_text():
    tree = {"source": {"mapping": [SOURCE]}, "spark-config": {"a.b": 1, "c": True}}
    assert PipelineSpec.from_dict(tree).settings == {"a.b": "1", "c": "true"}


def test_repeated_target_keys_keep_the_last_value():
    text = json.dumps({"source": {"mapping": [SOURCE]}})[:-1]
    text += ', "target": {"place": "hdfs"}, "target": {"place": "hive"}}'
    assert PipelineSpec.from_json(text).target == TargetSpec("hive")


def test_target_options():
    target = TargetSpec.from_dict(
        {"place": "hbase", "class": "x", "options": {"cf": "d", "a": {"b": 1}, "bulkload": "True"}}
    )
    assert target.require("cf", "a.b") == ["d", 1]
    assert target.flag("bulkload") and not target.flag("other")
    with pytest.raises(ValueError, match="needs option.*tablename"):
        target.require("cf", "tablename")


def test_lookup_prefers_nothing_over_an_error():
    assert lookup({"a": 1}, "a.b") is None
    assert lookup({"a.b": {"c.d": 2}}, "a.b.c.d") == 2
    assert lookup({"a": {"x": 1}, "a.b": 2}, "a.b", 0) == 2


def test_file(tmp_path):
    path = tmp_path / "job.json"
    path.write_text(json.dumps({"source": {"mapping": [SOURCE]}}))
    assert PipelineSpec.from_file(str(path)) == spec()
