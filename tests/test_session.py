"""Settings the operators count on."""

from skyloom.session import tune


def test_no_generated_method_is_too_long_for_the_compiler(spark):
    assert int(tune(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
