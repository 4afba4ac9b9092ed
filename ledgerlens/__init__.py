"""ledgerlens: a Spark-native sales-analytics engine.

Raw sales, customer, product, territory and budget data is cleaned into
typed Silver tables, joined into an enriched Gold fact, aggregated into
monthly KPIs, scored with RFM segmentation and evaluated by a measure
library.  Every step is a DataFrame transform that Catalyst plans and
Spark distributes; nothing is routed through the driver.
"""

from ledgerlens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
