"""Plans made of operators: request answering, exports, table bindings."""
