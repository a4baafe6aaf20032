"""A hand-made raw table set with one defect of most kinds."""

from __future__ import annotations

from marketlens.schema import RAW_COLUMNS

MINI = {
    "dim_customer": [
        ("C000001", "2021-01-01", "25-34", None, "Private", "Email", "  dealer referral "),
        ("C000001", "2021-01-01", "25-34", "ZH", "Private", "Email", "Dealer Referral"),
    ],
    "dim_vehicle": [
        ("V0000001", " volkswagen ", "Golf", "Hatchback", "Petrol", "2020", "-5000", "25000",
         "Good"),
    ],
    "dim_dealer": [
        ("D0001", " North Garage ", "Zurich", "Franchise", "4.5", "true"),
        ("D0002", "South Garage", "Espace Mittelland", "Independent", "4.0", "true"),
    ],
    "fact_inquiry": [
        ("I0000001", "C000001", "V0000001", "2022-01-01", "dealer referral", " converted ",
         "24000", "D9999", "true", "2"),
    ],
    "fact_quote": [
        ("Q00000001", "I0000001", "D0001", "2022-01-01", "24000", "4", "1", "true"),
        ("Q00000002", "I0000001", "D0002", "2022-01-02", "22000", None, "2", "false"),
    ],
    "dim_date": [
        ("2022-01-01", "2022", "Q1", "1", "January", "52", "Saturday", "true"),
        ("2022-01-02", "2022", "Q1", "1", "January", "52", "Sunday", "true"),
    ],
}


def raw_frames(spark, tables=None):
    """Raw frames whose `_ordinal` is the row position."""
    frames = {}
    for name, data in (tables or MINI).items():
        fields = ", ".join(f"{c} string" for c in RAW_COLUMNS[name])
        frames[name] = spark.createDataFrame(
            [(*row, i) for i, row in enumerate(data)], f"{fields}, _ordinal long")
    return frames


# Every reject rule and repair at once, by table; see test_clean for what becomes of each row.
DEFECTS = {
    "dim_customer": [
        ("c1 ", "2021-01-01", "25-34", "zh", "private", "e-mail", "PAID SEARCH"),
        ("C1", "2020-01-01", "25-34", "be", "private", "email", "Direct"),
        ("C2", "2025-99-41", "35-44", "be", "dealer", "phone", "Direct"),
        ("C3", "2023-01-01", "65+ x-y", "", "private", "phone", "carrier pigeon"),
    ],
    "dim_vehicle": [
        ("V1", "BMW", "X1", "SUV", "petrol", "2020", "900000", "25000", "good"),
        ("V2", "bmw ", "X3", "suv", "steam", "2019", "25000.5", "25000.005", "Good"),
        ("V3", "Lada", "Niva", "SUV", None, "1989", "10", "100", "Poor"),
        ("V4", "BMW", "X5", "SUV", "Diesel", "2018", "75000", "80000", "FAIR"),
        ("V4", "BMW", "X5", "SUV", "Diesel", "2018", "75001", "80000", "FAIR"),
    ],
    "dim_dealer": [
        ("D1", " North ", "Zurich", "Franchise", "4.555", "Y"),
        ("D2", "South", "Ticino", "Broker", "5.01", "true"),
        ("D3", "West", "Geneva", "Broker", "0", "perhaps"),
    ],
    "fact_inquiry": [
        ("I1", "C1", "V2", "2022-03-01", "direct", "converted", "1", "D1", "yes", "3"),
        ("I1", "C1", "V4", "2022-03-02", "direct", "lost", None, None, "no", None),
        ("I2", "C1", "V4", "not-a-date", "direct", "lost", None, None, "no", None),
        ("I3", "C2", "V4", "2022-03-01", "direct", "lost", None, None, "no", None),
        ("I4", "C1", "V1", "2022-03-01", "direct", "lost", None, None, "no", None),
        ("I5", "C3", "V4", "2022-03-01", "direct", "lost", None, None, "no", None),
        ("I6", "C1", "V4", "2022-04-01", "direct", "converted", "9", "D1", "true", "1"),
        ("I7", "C1", "V4", "2022-04-01", "unknown", "open", None, None, "no", None),
        ("I8", "C1", "V4", "2022-04-01", "partner", "converted", "5", "D1", "t", "1"),
        ("I9", "C1", "V4", "2022-04-01", "partner", "lost", None, None, "no", None),
    ],
    "fact_quote": [
        ("Q1", "I1", "D1", "2022-03-02", "20000", "2", "1", "true"),
        ("Q1", "I1", "D3", "2022-03-02", "21000", "2", "1", "false"),
        ("Q2", "I1", "D3", "2022-03-03", "20000", None, "2", "no"),
        ("Q3", "I1", "D1", "2022-02-28", "20000", "2", "3", "no"),
        ("Q4", "I1", "D1", "soon", "20000", "2", "4", "no"),
        ("Q5", "I1", "D1", "2022-03-05", "-1", "2", "5", "no"),
        ("Q6", "I1", "D1", "2022-03-05", "500000.01", "2", "6", "no"),
        ("Q7", "I1", "D2", "2022-03-05", "20000", "2", "7", "no"),
        ("Q8", "I3", "D1", "2022-03-05", "20000", "2", "1", "no"),
        ("Q9", "I6", "D2", "2022-04-05", "90000", "2", "1", "true"),
        ("Q10", "I6", "D3", "2022-04-05", "60000", "8", "2", "no"),
        ("Q11", "I8", "D1", "2022-04-05", "60000", "4", "1", "true"),
        ("Q12", "I8", "D3", "2022-04-05", "61000", "10", "2", "true"),
        ("Q13", "I9", "D3", "2022-04-01", "500000", "0", "1", "true"),
    ],
    "dim_date": [
        (f"2022-{m:02d}-{d:02d}", "2022", "Q1", str(m), "x", "1", "x", "false")
        for m, last in ((3, 31), (4, 30)) for d in range(1, last + 1)
    ] + [("2022-03-01", "2022", "Q1", "3", "x", "1", "x", "false"),
         ("nonsense", None, None, None, None, None, None, None)],
}
