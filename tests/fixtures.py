"""Hand-written input files with the edge rows of FIXTURES.md (all values invented)."""

from __future__ import annotations

import json
import os

COMPANY_HEADER = ("Symbol,Name,Sector,Price,Price/Earnings,Dividend Yield,Earnings/Share,"
                  "52 Week Low,52 Week High,Market Cap,EBITDA,Price/Sales,Price/Book,SEC Filings")

# ticker, name, sector, price, pe, dy, eps, low, high, cap, ebitda, ps, pb, url
COMPANY_ROWS = [
    'AAA,"Alpha, Inc.",Tech,100.00,20.50,1.10,4.88,80.00,120.00,250000000000,5000000000,3.10,4.20,f/AAA',
    "BBB,Beta Corp,Tech,50.00,,0.50,2.00,40.00,60.00,12000000000,800000000,2.00,1.50,f/BBB",
    "CCC,Gamma Ltd,Energy,30.00,10.00,2.00,3.00,30.00,30.00,2000000000,,1.00,0.80,f/CCC",
    "DDD,Delta Co,Energy,abc,12.00,1.00,1.00,10.00,20.00,5000000000,100000000,1.00,1.00,f/DDD",
    "EEE,Epsilon,Energy,25.00,15.00,1.00,1.00,20.00,30.00,NaN,100000000,1.00,1.00,f/EEE",
    "FFF,Phi Group,Health,10.00,5.00,1.00,1.00,8.00,12.00,0,100000000,1.00,1.00,f/FFF",
    "GGG,Gamma Two,Health,10.00,5.00,1.00,1.00,8.00,12.00,-5,100000000,1.00,1.00,f/GGG",
    "HHH,Eta Inc,Health,10.00,-3.00,1.00,1.00,0,12.00,10000000000,100000000,1.00,1.00,f/HHH",
    "III,Iota Inc,Tech,10.00,5.00,1.00,1.00,8.00,12.00,200000000000,100000000,1.00,1.00,f/III",
    ",No Symbol,Tech,10.00,5.00,1.00,1.00,8.00,12.00,3000000000,100000000,1.00,1.00,f/none",
    "JJJ,,Tech,10.00,5.00,1.00,1.00,8.00,12.00,3000000000,100000000,1.00,1.00,f/JJJ",
    "AAA,Alpha Duplicate,Tech,101.00,21.00,1.10,4.88,80.00,120.00,250000000000,5000000000,3.10,4.20,f/AAA2",
    # 0.125% -> half cent: ebitda / cap * 100 = 0.125 exactly
    "KKK,Kappa,Utilities,12.00,8.00,1.00,1.00,10.00,14.00,8000000000,10000000,1.00,1.00,f/KKK",
]


def write_company_csv(folder: str, name: str = "financials.csv") -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(COMPANY_HEADER + "\n" + "\n".join(COMPANY_ROWS) + "\n")
    return path


def _report(date, rev, net, cur="USD", equity="1000", opi="50", **extra):
    r = {"fiscalDateEnding": date, "totalRevenue": rev, "netIncome": net,
         "operatingIncome": opi, "stockholdersEquity": equity}
    if cur is not None:
        r["reportedCurrency"] = cur
    if equity is None:
        del r["stockholdersEquity"]
    if date is None:
        del r["fiscalDateEnding"]
    r.update(extra)
    return r


STATEMENTS = {
    "AAA_income_statement.json": {"symbol": "AAA", "annualReports": [
        _report("2023-12-31", "1000", "125"),
        _report("2022-12-31", "None", "100"),
        _report("2021-12-31", "800", "-100", cur=None, equity=None),
        _report("2020-12-31", "0", "10"),
        _report("2019-12-31", "-5", "10"),
        _report("20x8-12-31", "700", "70"),
        _report(None, "600", "60"),
        _report("2017-12-31", "9000000000000", "4500000000001", grossProfit="4000000000000"),
    ]},
    "BBB_income_statement.json": {"symbol": "BBB", "annualReports": []},
    "CCC_income_statement.json": {},
    "DDD_income_statement.json": {"Information": "rate limit reached"},
    "ZZZ_income_statement.json": {"annualReports": [_report("2023-12-31", "10", "1")]},
    "AAA_balance_sheet.json": {"symbol": "AAA", "annualReports": [
        {"fiscalDateEnding": "2023-12-31", "totalAssets": "5000", "totalLiabilities": "3000"}]},
    "AAA_cash_flow.json": {"symbol": "AAA", "annualReports": [
        {"fiscalDateEnding": "2023-12-31", "operatingCashflow": "300"}]},
}


def write_statements(folder: str) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, doc in STATEMENTS.items():
        with open(os.path.join(folder, name), "w") as f:
            json.dump(doc, f, indent=2)
    return folder


def _fact(end, val, form="10-K", **extra):
    d = {"end": end, "val": val, "form": form, "fy": 2020}
    if end is None:
        del d["end"]
    if val is None:
        del d["val"]
    d.update(extra)
    return d


FILINGS = {
    # many 10-K values, restatements (equal end, different val), 10-Q noise, missing end
    "AAA.json": {"entityName": "Alpha, Inc.", "facts": {"us-gaap": {
        "NetIncomeLoss": {"units": {"USD": [
            _fact("2019-12-31", 90), _fact("2020-12-31", 100), _fact("2021-12-31", 110),
            _fact("2021-12-31", 111), _fact("2022-12-31", 120), _fact("2022-06-30", 60, "10-Q"),
            _fact("2023-12-31", 130), _fact("2023-12-31", 131), _fact(None, 5),
            _fact("2018-12-31", 80),
        ]}},
        "Revenues": {"units": {"USD": [_fact("2023-12-31", 1000), _fact("2022-12-31", None)]}},
        "Assets": {"units": {"USD": [_fact("2023-12-31", 5000), _fact("2023-12-31", 4000)]}},
        "Liabilities": {"units": {"EUR": [_fact("2023-12-31", 3000)]}},
        "StockholdersEquity": {"units": {"USD": [_fact("2023-06-30", 1, "10-Q")]}},
        "EarningsPerShareBasic": {"units": {"USD/shares": [_fact("2023-12-31", 3)]}},
    }, "dei": {"EntityCommonStockSharesOutstanding": {"units": {"shares": [_fact("2023-12-31", 7)]}}}}},
    "BBB.json": {"entityName": "Beta Corp", "facts": {"ifrs-full": {}}},
    "CCC.json": {"entityName": "Gamma"},
    "DDD.json": {},
}


def write_filings(folder: str) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, doc in FILINGS.items():
        with open(os.path.join(folder, name), "w") as f:
            json.dump(doc, f, indent=2)
    return folder


def python_top5(values, k=5):
    """Which facts a document keeps, found one by one: of the annual facts not taken yet, the
    first of those with the latest period."""
    taken = []
    while len(taken) < k:
        best = None
        for at, fact in enumerate(values):
            if at in taken or fact.get("form") != "10-K":
                continue
            if best is None or (fact.get("end") or "") > (values[best].get("end") or ""):
                best = at
        if best is None:
            break
        taken.append(best)
    return [values[at] for at in taken]
