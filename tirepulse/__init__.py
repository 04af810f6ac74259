"""tirepulse: fleet tyre/hub telemetry analytics as Spark jobs.

Two daily report tables (wheel sensors and vehicle hubs) feed rolling
statistics, rule-based issue classification with risk scores, an
isolation forest with readable reasons, and availability / connectivity /
fleet-status indicators. Every function returns a lazy DataFrame.
"""

__version__ = "0.1.0"
