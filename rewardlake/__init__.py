"""rewardlake: Spark-native preparation and reward scoring of RL fine-tuning data.

Modules
-------
functions   Column functions (text rules, JSON decoding)
sources     reads, sinks, counters, stand-in tables
operators   converters, scorers, episode replay, result sets, monitors, plug-ins
streaming   Structured Streaming forms of the scorers and monitors
plans       the registered queries and their SQL oracles
session     session defaults and the shared checkpoint folder
"""

__version__ = "0.1.0"
