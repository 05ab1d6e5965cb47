"""The nine-merchant hand fixture and its expected results (FIXTURES.md)."""

from merchpulse.schema import METRIC_LONG

AS_OF = "2015-12-15"


def _rows():
    r = []

    def add(k, code, pairs):
        for month, value in pairs:
            r.append((k, month, code, value))

    add("A", "M_SALE_AMOUNT", [("201506", "10000"), ("201507", "12000"), ("201508", "11000"), ("201509", "15000"),
                               ("201510", "18000"), ("201511", "21000"), ("201406", "8000"), ("201407", "9000"),
                               ("201408", "10000"), ("201409", "11000"), ("201410", "12000"), ("201411", "13000"),
                               ("201505", "99999"), ("201512", "99999")])
    add("A", "M_DEAL_CUST_CNT", [("201506", "800"), ("201507", "900"), ("201508", "850"), ("201509", "1000"),
                                 ("201510", "1200"), ("201511", "1300")])
    add("A", "M_CUST_ONE_PRICE", [("201506", "12.5"), ("201507", "13.3"), ("201508", "12.9"), ("201509", "15"),
                                  ("201510", "15"), ("201511", "16.1")])
    add("A", "M_REFUND_RATE", [("201506", "5%"), ("201507", "6.5%"), ("201508", "4%"), ("201509", "7%"),
                               ("201510", "8%"), ("201511", "3.5%")])
    add("A", "M_TOP3_GOODS_REVENUE", [("201506", "3000"), ("201507", "3500"), ("201508", "3000"), ("201509", "4000"),
                                      ("201510", "5000"), ("201511", "6000")])
    add("A", "M_TOP10_CUST_REVENUE", [("201506", "1000"), ("201507", "900"), ("201508", "950"), ("201509", "1200"),
                                      ("201510", "1300"), ("201511", "1500")])
    add("A", "M_OTHER", [(m, "1") for m in ("201506", "201507", "201508", "201509", "201510", "201511")])
    add("B", "M_SALE_AMOUNT", [("201506", "100"), ("201508", "300"), ("201509", "450"), ("201508", "300.0")])
    add("B", "M_REFUND_RATE", [("201506", "10%"), ("201507", "50%"), ("201509", "20%")])
    add("B", "M_DEAL_CUST_CNT", [("201506", "7"), ("201508", "6")])
    add("C", "M_SALE_AMOUNT", [("201510", "60000")])
    add("C", "M_CUST_ONE_PRICE", [("201510", "20")])
    add("C", "M_TOP3_GOODS_REVENUE", [("201510", "60000")])
    add("D", "M_CUST_ONE_PRICE", [("201507", "10"), ("201511", "30")])
    add("E", "M_REFUND_RATE", [(m, "1%") for m in ("201506", "201507", "201508", "201509", "201510", "201511")])
    add("F", "M_SALE_AMOUNT", [(m, "5") for m in ("201406", "201407", "201408", "201409", "201410", "201411")])
    add("G", "M_SALE_AMOUNT", [("201509", "0")])
    add("G", "M_REFUND_RATE", [("201509", "2%")])
    add("G", "M_DEAL_CUST_CNT", [("201509", "18000")])
    add("H", "M_SALE_AMOUNT", [("201506", "100"), ("201506", "200"), ("201507", "400")])
    add("H", "M_REFUND_RATE", [("201506", "10%"), ("201507", "5%")])
    add("I", "M_SALE_AMOUNT", [("201506", "5000"), ("201507", "5000"), ("201508", "5000"), ("201509", "5000"),
                               ("201510", "5000"), ("201511", "4999.97")])
    return r


ROWS = _rows()

N = None
EXPECTED_QUOTAS = {
    "A": (14500.0, 1008, 5.68, 29.82, 10.13, 28.16, 7.87, 138.1, 116.94, 4),
    "B": (141.67, 2, 11.76, 61.97, N, N, N, N, 150.0, 1),
    "C": (10000.0, N, N, N, N, 100.0, N, N, N, N),
    "D": (N, N, N, N, 70.71, N, N, N, N, N),
    "G": (0.0, 3000, N, N, N, N, N, N, N, N),
    "H": (116.67, N, 7.14, 65.47, N, N, N, N, 300.0, 2),
    "I": (5000.0, N, N, 0.0, N, N, N, N, 100.0, 0),
}
EXPECTED_SCORES = {
    "A": (5, 8, 8, 10, 10, 7, 10, 4, 6, 8),
    "B": (1, 6, 5, 4, N, N, N, N, 10, 2),
    "C": (5, N, N, N, N, 1, N, N, N, N),
    "D": (N, N, N, N, 1, N, N, N, N, N),
    "G": (1, 3, N, N, N, N, N, N, N, N),
    "H": (1, N, 6, 4, N, N, N, N, 10, 4),
    "I": (3, N, N, 10, N, N, N, N, 6, 0),
}
EXPECTED_FINAL = {"A": 73, "B": 38, "C": 39, "D": 10, "G": 16, "H": 38, "I": 38}


def metrics_frame(spark, rows=None, partitions=None):
    df = spark.createDataFrame(rows if rows is not None else ROWS, METRIC_LONG)
    return df.repartition(partitions) if partitions else df
