import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("cleanspark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():  # tests only: a scratch folder stands in for the cluster's shared one
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cleanspark-test-ckpt-"))
    yield s
    s.stop()


# Seven rows with the defects that cleaning is about: stray blanks and case, a national and an international spelling of
# one phone, a broken e-mail, phone and date, missing values, a negative and a far amount, a copy under another id.
CUSTOMERS_7 = [
    ("11", "  Olfa  ", "Olfa@mail.tn", " +216 22 33 44 55 ", "Sousse", "TN", "2023-05-09", "80.5"),
    ("12", "Tarek", "tarek@mail.tn", "+216-98-76-54-32", "Gabes", "TN", "2023/06/07", "45.25"),
    ("13", "OLFA", "olfa@mail.tn", "22334455", "Sousse", "TN", "09-05-2023", "80.5"),
    ("14", "Rania", "rania#mail.tn", "no_phone", "Bizerte", "TN", "2023-14-01", "2500"),
    ("15", None, "sonia@mail.tn", "+33 1 44 55 66 77", "Nice", "FR", "2022-12-30", "60"),
    ("16", "Walid", "walid@mail.tn", None, "Metz", "FR", "2023-02-01", "-12"),
    ("17", "Tarek", "tarek@mail.tn", "+216-98-76-54-32", "Gabes", "TN", "2023/06/07", "45.25"),
]
CUSTOMER_HEADER = ["customer_id", "name", "email", "phone", "city", "country", "signup_date", "amount"]


@pytest.fixture()
def customers7(spark):
    return spark.createDataFrame(CUSTOMERS_7, CUSTOMER_HEADER)
