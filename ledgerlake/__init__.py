"""ledgerlake: company-financials analytics on Spark DataFrames.

Sources (`sources`), operators (`operators`), column functions (`functions`),
composite jobs and registered queries (`plans`) and sinks (`sinks`). Library functions take and return DataFrames; none creates a
session or collects data to the driver.
"""

__version__ = "0.1.0"
