"""curatrix.functions"""
