"""The cost-and-usage specification: columns, types and which are required."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, kinds and levels that input files follow, in name order.
COLUMNS = """
AvailabilityZone string recommended
BilledCost decimal mandatory
BillingAccountId string mandatory
BillingAccountName string mandatory
BillingCurrency string mandatory
BillingPeriodEnd time mandatory
BillingPeriodStart time mandatory
CapacityReservationId string conditional
CapacityReservationStatus string conditional
ChargeCategory string mandatory
ChargeClass string mandatory
ChargeDescription string mandatory
ChargeFrequency string recommended
ChargePeriodEnd time mandatory
ChargePeriodStart time mandatory
CommitmentDiscountCategory string conditional
CommitmentDiscountId string conditional
CommitmentDiscountName string conditional
CommitmentDiscountQuantity decimal conditional
CommitmentDiscountStatus string conditional
CommitmentDiscountType string conditional
CommitmentDiscountUnit string conditional
ConsumedQuantity decimal conditional
ConsumedUnit string conditional
ContractedCost decimal mandatory
ContractedUnitPrice decimal conditional
EffectiveCost decimal mandatory
InvoiceIssuerName string mandatory
ListCost decimal mandatory
ListUnitPrice decimal conditional
PricingCategory string conditional
PricingQuantity decimal mandatory
PricingUnit string mandatory
ProviderName string mandatory
PublisherName string mandatory
RegionId string conditional
RegionName string conditional
ResourceId string conditional
ResourceName string conditional
ResourceType string conditional
ServiceCategory string mandatory
ServiceName string mandatory
ServiceSubcategory string recommended
SkuId string recommended
SkuMeter string recommended
SkuPriceDetails string optional
SkuPriceId string conditional
SubAccountId string mandatory
SubAccountName string mandatory
Tags json mandatory
"""
KINDS = {"string": T.StringType(), "json": T.StringType(), "decimal": T.DecimalType(38, 32), "time": T.TimestampType()}
SPEC: list[tuple[str, str, str]] = [tuple(line.split()) for line in COLUMNS.strip().splitlines()]
MANDATORY = [name for name, _, level in SPEC if level == "mandatory"]
PARTITIONS = ["year", "month", "day"]
SCHEMA = T.StructType([T.StructField(name, KINDS[kind]) for name, kind, _ in SPEC] + [T.StructField("year", T.LongType()), T.StructField("month", T.StringType()), T.StructField("day", T.StringType())])
