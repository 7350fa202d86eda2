"""C1-C13, P1, P2 on inline lines (FIXTURES §3)."""

from pyspark.sql import functions as F

from hourglass.functions import lines as L
from hourglass.operators import clean as C
from hourglass.operators import profile as P


def cells29(**over):
    cells = [f"v{i}" for i in range(29)]
    for k, v in over.items():
        cells[int(k[1:])] = v
    return ",".join(cells)


def run(spark, values):
    df = spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], "k long, value string")
    return {r.row_key: (r.is_malformed, r.value)
            for r in C.clean_crash_lines(df, key_col="k", keep_flag=True).collect()}


def kept(line):
    cells = line.split(",")
    return [c for i, c in enumerate(cells) if i not in (6, 10, 11)]


def test_clean_line_unchanged(spark):
    line = cells29()
    out = run(spark, [line])[1]
    assert out == (False, ",".join(["1", *kept(line)]))
    assert len(out[1].split(",")) == 27


def test_parenthesised_location_repaired(spark):
    line = cells29(c6='"(40.7, -73.9)"')
    malformed, value = run(spark, [line])[1]
    assert not malformed
    assert value.split(",")[1:] == kept(cells29(c6='""'))


def test_quoted_street_repaired(spark):
    line = cells29(c7='"MAIN ST, APT 2"')
    malformed, value = run(spark, [line])[1]
    assert not malformed
    assert value.split(",")[7] == "MAIN ST APT 2"


def test_both_problems_quarantined(spark):
    line = cells29(c6='"(40.7, -73.9)"', c7='"MAIN ST, APT 2"')
    malformed, value = run(spark, [line])[1]
    assert malformed
    assert value == ",".join(["1"] + ["-1"] * 26)


def test_trailing_empty_cells_kept_and_filled(spark):
    line = cells29(c26="", c27="", c28="")
    malformed, value = run(spark, [line])[1]
    assert not malformed
    assert value.split(",")[-3:] == ["-1", "-1", "-1"]


def test_short_line_quarantined(spark):
    line = ",".join(f"v{i}" for i in range(27))
    assert run(spark, [line])[1] == (True, ",".join(["1"] + ["-1"] * 26))


def test_two_quoted_commas_merge_greedily(spark):
    df = spark.createDataFrame([('x,"A, B, C",y',)], "value string")
    assert df.select(L.unquote_comma("value")).first()[0] == "x,A, B C,y"
    assert df.select(L.strip_parenthesised(F.lit("a(1,2)b(3)c"))).first()[0] == "ac"


def test_repair_only_above_max_commas(spark):
    df = spark.createDataFrame([('a,"b,c"',)], "value string")
    assert df.select(L.repair_delimiters("value", max_commas=2)).first()[0] == 'a,"b,c"'
    assert df.select(L.repair_delimiters("value", max_commas=1)).first()[0] == "a,bc"


def test_distinct_lines_sorted_by_bytes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("B",)], "value string")
    assert [r.value for r in C.distinct_lines(df).collect()] == ["B", "a", "b"]


def test_context_lines(spark):
    full = ",".join(f"c{i}" for i in range(12))
    short = ",".join(f"c{i}" for i in range(9))
    trailing = ",".join(f"c{i}" for i in range(9)) + ",,,"
    df = spark.createDataFrame([(1, full), (2, short), (3, trailing)], "k long, value string")
    out = {r.k: (r.value, r.is_short) for r in C.clean_context_lines(df, key_col="k").collect()}
    assert out[1] == ("c0,c1,c2,c3,c4,c5,c6,c8,c9", False)
    assert out[2] == (None, True)
    assert out[3] == (None, True)   # Java split drops the trailing empty cells


def test_context_line_filter(spark):
    rows = [(0, "hour_beginning,location,Pedestrians,a,b,w,t,p,lat,long,e,l"),
            (5, "t,loc,10,a,b,,t,p,lat,long,e,l"),
            (6, "t,loc,0,a,b,rain,t,p,lat,long,e,l"),
            (7, "t,loc,3,a,b,rain,t,p,lat,long,e,l")]
    df = spark.createDataFrame(rows, "k long, value string")
    out = C.clean_context_lines(df, key_col="k", drop_rows=True).collect()
    assert [r.k for r in out] == [7]


def test_count_records(spark):
    lines = ["CRASH DATE,CRASH TIME", "0,CRASH DATE,CRASH TIME", "01/01/2020,1:00", "01/02/2020,2:00"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    row = P.count_records(df).first()
    assert (row.label, row.n_records) == (P.RECORDS_LABEL, 2)
    keyed = spark.createDataFrame([(0, "hour_beginning,location"), (40, "x,location"), (80, "y")],
                                  "offset long, value string")
    assert P.count_records_skip_header(keyed).first().n_records == 2


def test_crash_table_names_kept_cells(spark):
    line = cells29(c0="01/02/2020", c1="3:04", c2="BROOKLYN", c18="", c23="77")
    df = spark.createDataFrame([(5, line)], "k long, value string")
    row = C.crash_table(df, key_col="k").first()
    assert len(row) == 27 and row.row_id == 5
    assert (row.crash_date, row.crash_time, row.borough) == ("01/02/2020", "3:04", "BROOKLYN")
    assert (row.on_street, row.ped_injured, row.factor_1, row.collision_id, row.vehicle_5) == \
        ("v7", "v12", "-1", "77", "v28")
