"""headstart.functions"""
