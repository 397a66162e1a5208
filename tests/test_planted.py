"""Planted tables are made from written ones."""

from ledgerlift.workloads import defects

SF = "/root/testdata/sf0.001"


def test_planted_tables_do_not_work_out_the_views_again(spark):
    for key, made in defects.planted_tables(spark, SF).items():
        for df in made:
            assert df.inputFiles() and not any(SF in f for f in df.inputFiles()), key
        plain = defects.planted(spark, SF, key)
        assert all(a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() for a, b in zip(made, plain, strict=True)), key
