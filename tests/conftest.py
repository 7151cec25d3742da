from __future__ import annotations

import datetime as dt

import pytest

from stoptide import session

UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build("local[4]", 4, **{
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


def rows(df, *columns):
    """Rows as tuples, in a stable order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(df):
    (row,) = df.collect()
    return row


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# A plan of five stops: one that ends here, one that begins here, a night train under a negative
# id and without platforms, one without any train, and one that only says where it goes.
PLAN_XML = """<timetable station="Kassel-Wilhelmsh&#246;he">
<s id="771042-2607040518-9"><tl c="EC" n="115" o="80" f="F" t="p"/>
<ar pt="2607041022" pp="7" ppth="Hamburg-Altona|Hannover Hbf|G&#246;ttingen"/></s>
<s id="20415-2607041030-1"><tl n="31520" c="S" o="R1" f="S"/><dp pt="2607041030" pp="11 D-F" ppth="Zierenberg"/></s>
<s id="-3390125517-2607032040-12"><tl c="NJ" n="470" f="F" o="81"/>
<dp pt="2607040351"/><ar pt="2607040347"/></s>
<s id="8811-2607040544-3"><ar pt="2607040601"/><dp pt="2607040602"/></s>
<s id="5-2607042355-2"><tl c="RB" n="5" o="CAN" f="N"/><dp ppth="Melsungen"/></s>
</timetable>"""
NIGHT, EAST, NO_TRAIN = "-3390125517-2607032040-12", "771042-2607040518-9", "8811-2607040544-3"
LOST = "940-2607040100-7"
# Changes of four of them, of one stop that no plan has, and of one without an id.
CHANGE_XML = """<timetable station="Kassel-Wilhelmsh&#246;he" eva="8003200">
<s id="-3390125517-2607032040-12"><dp ct="2607040404" cpth="Fulda|W&#252;rzburg Hbf"/></s>
<s id="20415-2607041030-1"><m t="d" cat="Information"/><dp ct="2607041031" cp="12"/></s>
<s id="940-2607040100-7"><dp ct="2607040233" cs="a" fb="EN 40"/><m c="36"/></s>
<s><ar ct="2607041100"/></s>
<s id="771042-2607040518-9"><ar cs="c" clt="2607040915" fb="EC 115"/></s>
<s id="8811-2607040544-3"><ar cp="3"/><m t="h" c="43" cat="St&#246;rung"/><m t="f" c="2"/></s>
</timetable>"""


def documents(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "document STRING")


def poll(spark, *texts):
    from pyspark.sql import functions as F

    from stoptide.sources.documents import change_stops

    return change_stops(documents(spark, *texts)).select(
        "*", F.lit(8003200).cast("long").alias("station_eva"),
        F.lit("Kassel-Wilhelmshöhe").alias("station_name"),
        F.lit("2026-07-04T10:25:30+02:00").alias("observed_at"))
