"""Column -> Column builders. Everything here is a native Catalyst
expression (whole-stage codegen); there is no Python UDF in the package."""
