"""Pure Column functions: text, forecast identity, fields, geometry, projection."""
