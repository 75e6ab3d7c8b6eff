"""footfall: shopping-mall sensor and till analytics on Spark.

Main entry points (each takes and returns DataFrames, batch or stream):

* ``footfall.operators.foot_traffic``: ``running_visitors``,
  ``foot_traffic_window_join_12``, ``foot_traffic_as_coded``,
  ``foot_traffic_factors``, ``foot_traffic_intended``
* ``footfall.operators.proximity``: ``classify_area``,
  ``proximity_traffic_as_coded``, ``traffic_jam_as_coded``, ``offer_alerts``,
  ``offer_recipients``, ``proximity_traffic_intended``, ``capture_rate``
* ``footfall.operators.instore``: ``category_count``, ``payment_method_count``,
  ``stock_availability``, ``total_sales_as_coded``, ``total_sales_intended``,
  ``most_used_payment_method``, ``underperforming_categories``,
  ``sale_sessions``, ``items_by_shop``
* ``footfall.operators.journey``: ``customer_journey``, ``visit_history``,
  ``sales_conversion``
* ``footfall.operators.scan.keyed_scan``: ordered per-key values, balanced
  under hot keys; ``footfall.operators.carry``: the same, from run to run
* ``footfall.operators.area_grid.classify_by_table``: areas as a table of boxes
* ``footfall.operators.shared``: the in-store results from one read
* ``footfall.operators.rollup``: day tables of devices, rolled up to any span
* ``footfall.streaming.jobs``: ``start_foot_traffic``, ``start_proximity``,
  ``start_instore``, ``start_instore_shared``; ``footfall.cli`` starts them from
  the command line
* ``footfall.streaming.published``: runs, commit records, the latest documents;
  ``footfall.streaming.clock``: ticks for silent inputs
* ``footfall.settings.Settings``: window sizes, thresholds, labels
"""
