"""Spark-native fraud-risk analytics: messages -> lake -> typed -> clean -> mart -> serving."""

from riskmart.specs import ACTIVITY, CLIENTS, LOGINS, PAYMENTS, SPECS, TRANSACTIONS, TableSpec

__all__ = ["ACTIVITY", "CLIENTS", "LOGINS", "PAYMENTS", "SPECS", "TRANSACTIONS", "TableSpec"]
