"""Record types, as DDL. Dynamic JSON values are VARIANT; inside streaming state they are JSON strings."""

OBJECT = "map<string, variant>"
ENRICHMENTS = "map<string, map<string, variant>>"
CLIENT_FIELDS = ("clientId", "firstName", "lastName", "email", "phone", "address", "city", "country", "registrationDate", "tier")
